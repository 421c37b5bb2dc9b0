"""Three-valued-logic helpers.

The source work-queue filters with pandas masks, where ``!=`` and ``~isin``
keep missing values. SQL comparisons drop NULL, so every "keep unless" filter
must be written null-safe. These helpers are the only place that logic lives.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ne_keep_null(c: Column, value) -> Column:
    """``c != value`` that is TRUE for NULL ``c`` (pandas ``!=``)."""
    return ~c.eqNullSafe(F.lit(value))


def not_in_keep_null(c: Column, values: Iterable) -> Column:
    """``~c.isin(values)`` that keeps NULL ``c``; NULLs in ``values`` are ignored."""
    vals = [v for v in values if v is not None]
    if not vals:
        return F.lit(True)
    return ~F.coalesce(c.isin(vals), F.lit(False))


def match_or_false(pred: Column) -> Column:
    """A predicate whose NULL (unknown) result counts as 'no match'."""
    return F.coalesce(pred, F.lit(False))


def is_yes(c: Column) -> Column:
    """Two-valued ``c == 'Yes'`` (NULL -> FALSE)."""
    return c.eqNullSafe(F.lit("Yes"))
