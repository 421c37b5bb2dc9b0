from billflow.functions.nulls import (  # noqa: F401
    ne_keep_null, not_in_keep_null, match_or_false, is_yes,
)
