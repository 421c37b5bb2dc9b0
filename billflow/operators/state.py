"""Case state as an append-only log (O-44) and run metrics (O-37/38).

Same-job metrics for a written output use ``DataFrame.observe`` (see
``plans.scrub.run_scrub``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_current(log: DataFrame, fields: list[str], key: str = "case_id") -> DataFrame:
    """Latest value of each field per case, one wide row per case. Of events with
    the same ``seq`` the larger value counts, so the result does not depend on their order.

    One aggregation: for every field, ``max_by(value, seq)`` over that field's
    events only (other rows give a NULL ordering and are skipped). It combines
    map-side, so a case with a third of all events is pre-reduced before the
    shuffle; no pivot pass is needed.
    """
    order = F.struct(F.col("seq"), F.col("value"))
    aggs = [F.max_by(F.col("value"), F.when(F.col("field") == f, order)).alias(f) for f in fields]
    return log.groupBy(key).agg(*aggs)


def append_state(log: DataFrame, changes: DataFrame) -> DataFrame:
    """Add new state events (the log is never updated in place)."""
    return log.unionByName(changes.select(*log.columns))


def stage_counts(tagged: DataFrame, col: str = "route") -> DataFrame:
    """Rows per stage / route."""
    return tagged.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
