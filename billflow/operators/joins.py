"""Join helpers and the broadcast policy.

Two kinds of small side exist:

* config tables (rule lists, provider masters): hinted with ``broadcast`` only
  after one bounded pass (``df.limit(n + 1)``) proves both their rows and their
  bytes small; beyond either bound the hint is dropped.
* data-sized tables (client export, registry, service lines, coverage,
  invoices, outcomes): never hinted to be broadcast. They are only while the
  planner's estimate *and* their measured size are under
  ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-decides from measured
  shuffle sizes; otherwise the join is sort-merge with AQE splitting skewed
  partitions. The estimate alone won't do: it starts from compressed files
  and takes a generator for one row out of each row in.

Results are identical either way; only the physical strategy changes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Row bound for broadcasting a config table; ~2M narrow rows stays well under the
# default 8 GB broadcast ceiling and executor memory. Per session it can be set
# with ``spark.billflow.broadcastMaxRows`` (0 disables the explicit hints).
DEFAULT_BROADCAST_ROWS = 2_000_000
MAX_ROWS_CONF = "spark.billflow.broadcastMaxRows"
# And the bound on its size: the text length of all values, and 16 bytes for each.
MAX_BYTES = 128 << 20


_CHECKED: dict[tuple, bool] = {}
_MEASURED: dict[tuple, int] = {}


def broadcast_row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def _leaves(t) -> int:
    return sum(_leaves(f.dataType) for f in t) if isinstance(t, StructType) else 1


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about: the text length of its values, and 16 for each."""
    width = F.lit(16 * _leaves(df.schema))
    for c in df.columns:
        width = width + F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return width


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` provably holds at most ``max_rows`` rows and ``MAX_BYTES`` bytes.

    The bounded pass runs once per distinct plan over the same files in an
    application; a config table joined by several operators is measured once, and
    again when it is read from other (or more) files.
    """
    max_rows = broadcast_row_limit(df) if max_rows is None else max_rows
    if max_rows <= 0:
        return False
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(df.inputFiles()), max_rows)
    if key not in _CHECKED:
        rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
        _CHECKED[key] = rows <= max_rows and size <= MAX_BYTES
    return _CHECKED[key]


def maybe_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when the size check passes, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def null_safe_left_join(left: DataFrame, dim: DataFrame, left_key: str,
                        right_key: str) -> DataFrame:
    """Left join where a NULL key matches a NULL key and duplicates fan out.

    ``<=>`` plans as an equi join on ``(coalesce(k, ''), isnull(k))``, so it
    stays a hash join: broadcast while ``dim`` is, as measured, under the planner's
    size threshold, sort-merge beyond it. There all NULL keys share one reducer;
    AQE's skew-join rule splits that partition of ``left`` (the NULL part of
    ``dim`` is what gets replicated, and it is small in any master table).
    """
    return left.join(sized(dim), F.col(left_key).eqNullSafe(F.col(right_key)), "left")


def semi_on(left: DataFrame, right: DataFrame, cond: Column | list, how: str,
            max_rows: int | None = None) -> DataFrame:
    """``left_semi`` / ``left_anti`` with a checked broadcast of ``right``."""
    return left.join(maybe_broadcast(right, max_rows), cond, how)


# Salts of NULL keys, which match nothing; hot keys measured at most, and keys that the sketch tracks
# for them (its error is 3.5 / TRACKED of the rows, less than the share of a key that counts as hot).
NULL_SALTS, HOT_MOST, TRACKED = 512, 512, 8192


def _estimated_small(df: DataFrame) -> int | None:
    """The planner's threshold, where its estimate of ``df`` is not above it."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit
    return limit if small else None


def planner_broadcasts(right: DataFrame) -> bool:
    """Whether ``right`` is to be broadcast, so that nothing is shuffled: the planner would by its own estimate and
    threshold, and the size of ``right``, measured once for a plan over the same files, is not above it.

    Its rows are counted first, which reads their keys alone; only few enough rows are then measured by their text.
    """
    limit = _estimated_small(right)
    if limit is None:
        return False
    key = (right.sparkSession.sparkContext.applicationId, right.semanticHash(), tuple(right.inputFiles()))
    size = _MEASURED.get(key)
    if size is None:
        size = 16 * _leaves(right.schema) * right.count()
        if size <= limit:
            size = right.agg(F.coalesce(F.sum(_width(right)), F.lit(0))).first()[0]
        _MEASURED[key] = size
    return size <= limit


def shuffled(right: DataFrame) -> DataFrame:
    """``right``, which is too large to be broadcast, for a join: hinted so where the planner's estimate says else."""
    return right if _estimated_small(right) is None else right.hint("merge")


def sized(right: DataFrame) -> DataFrame:
    """``right`` for a join that may broadcast it by its measured size only."""
    return right if planner_broadcasts(right) else shuffled(right)


def hot_keys(rows: DataFrame, keys: list[Column]) -> dict[int, int]:
    """The keys that hold more than one task's share of ``rows``: hash of the key -> tasks to deal its rows over.

    One pass with a heavy-hitter sketch, combined map-side. At most ``HOT_MOST`` keys reach the driver;
    a key beyond these holds less than 1 / ``HOT_MOST`` of the rows. A key gets tasks by its count, all of
    them from a quarter of the rows on. Rows with a NULL in the key are left out.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.lit(True)
    for k in keys:
        whole = whole & k.isNotNull()
    key = rows.select(F.when(whole, F.xxhash64(*keys)).alias("key"))
    found = key.agg(F.count(F.lit(1)).alias("n"),
                    F.expr(f"approx_top_k(key, {HOT_MOST}, {TRACKED}) FILTER (WHERE key IS NOT NULL)").alias("top")).first()
    least = max(found.n / tasks, found.n / HOT_MOST)
    return {r.item: min(tasks, math.ceil(4 * tasks * r["count"] / found.n)) for r in found.top or [] if r["count"] > least}


def unique_left_join(left: DataFrame, right: DataFrame, on: list[tuple[Column, str]], salt_by: str,
                     rows: DataFrame | None = None) -> DataFrame:
    """Left join to a ``right`` that holds at most one row per key.

    ``right`` is an aggregate, and a partition of ``left`` that one hot key fills is not split by the
    planner against an aggregate. So, unless ``right`` is broadcast, hot keys are measured: the rows of
    each are dealt over tasks by its count (by ``salt_by``), and only its row of ``right`` is repeated for
    them. Every other key is shuffled once on either side. A NULL key matches nothing; such rows are dealt
    over ``NULL_SALTS`` salts.

    ``rows`` is measured instead of ``left``: a table with the keys of the same rows that is cheaper to read,
    such as the cases at the start of a chain of joins. What is measured decides where rows
    go, never the result.
    """
    keys, names = [k for k, _ in on], [n for _, n in on]
    cond, null = F.lit(True), F.lit(False)
    for k, name in on:
        cond, null = cond & (k == F.col(name)), null | k.isNull()
    if planner_broadcasts(right):
        return left.join(right, cond, "left")
    types = [[f.dataType for f in side.schema] for side in (left.select(*keys), right.select(*names))]
    if types[0] != types[1]:
        raise TypeError(f"keys of unlike types, whose hashes differ: {types}")
    hot = hot_keys(left if rows is None else rows, keys)

    def salts(cols) -> Column:
        if not hot:
            return F.lit(1).cast("bigint")
        table = F.create_map(*[F.lit(x).cast("bigint") for pair in hot.items() for x in pair])
        return F.coalesce(F.try_element_at(table, F.xxhash64(*cols)), F.lit(1).cast("bigint"))

    lot = F.xxhash64(salt_by)
    salt = F.when(null, F.pmod(lot, F.lit(NULL_SALTS))).otherwise(F.pmod(lot, salts(keys)))
    # a generator, as a constant salt would be folded away and NULL keys meet in one task again
    r = right.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), salts(names) - 1)).alias("_right_salt"))
    return (left.withColumn("_left_salt", salt).join(shuffled(r), cond & (F.col("_left_salt") == F.col("_right_salt")), "left")
            .drop("_left_salt", "_right_salt"))


def of_keys(table: DataFrame, col: str, keys: DataFrame | None) -> DataFrame:
    """The rows of ``table`` whose ``col`` is among ``keys`` (one column, any name);
    all rows when ``keys`` is None. Used to cut a history to a day's keys before it is reduced.
    The keys keep their repeats: both sides are plain shuffles then, and AQE splits what a hot key fills."""
    if keys is None:
        return table
    k = keys.select(F.col(keys.columns[0]).alias("_day_key"))
    return table.join(k, F.col(col) == F.col("_day_key"), "left_semi")
