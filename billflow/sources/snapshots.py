"""O-44: a compacted case state, and the events since then.

The state log grows by a few files a day and never changes otherwise. A snapshot holds,
for every case, the latest (seq, value) of each field over the log files that it covers;
it is stored in buckets of the case id, sorted. The current state is the snapshot joined
with the reduced events of the files that it does not cover: only those and the day's
cases are shuffled, to the snapshot's buckets, and the history is read as it lies.

"Latest" is a maximum, so files may be added in any order and late events count as they
should. A file that was replaced (a day run again) or removed is another matter: a
snapshot is taken only while every file it covers is still there, unchanged; else an older
one, or the whole log. A snapshot is seen only once the list of its files is written,
which is its last step, so a compaction that dies leaves nothing that is read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billflow.sources.files import read_if_exists

KEY = "case_id"
BUCKETS = 64
FILES = T.StructType([T.StructField("snap", T.StringType()), T.StructField("file", T.StringType()),
                      T.StructField("changed", T.TimestampType()), T.StructField("size", T.LongType()),
                      T.StructField("last", T.LongType()), T.StructField("made", T.TimestampType()),
                      T.StructField("buckets", T.IntegerType())])
SAME = ["file", "changed", "size"]


def latest(events: DataFrame, fields: list[str]) -> DataFrame:
    """Per case the largest (seq, value) of each field, combined map-side."""
    order = F.struct(F.col("seq"), F.col("value"))
    return events.groupBy(KEY).agg(*[F.max(F.when(F.col("field") == f, order)).alias(f) for f in fields])


def _root(log: str) -> str:
    return f"{log.rstrip('/')}/_snapshots"


def _stamp() -> list[Column]:
    """A file as the reader of its rows saw it."""
    m = F.col("_metadata")
    return [m["file_path"].alias("file"), m["file_modification_time"].alias("changed"), m["file_size"].alias("size")]


def log_files(spark: SparkSession, log: str) -> DataFrame:
    """(path, file, changed, size) of the log's files, from their listing; snapshots are hidden from it."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
            .load(log).select("path", *_stamp()))


def _covered(spark: SparkSession, log: str) -> DataFrame:
    return read_if_exists(spark, f"{_root(log)}/files", FILES)


def stored(spark: SparkSession, log: str, snap: str, buckets: int) -> DataFrame:
    """A snapshot, declared with its buckets (the session's catalog need not know it from before)."""
    name, path = f"state_snapshot_{snap}", f"{_root(log)}/state/{snap}"
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"create table {name} ({cols}) using parquet clustered by (`{KEY}`) sorted by (`{KEY}`) "
                  f"into {buckets} buckets location '{path}'")
    return spark.table(name)


def usable(spark: SparkSession, log: str, before: int | None = None):
    """The newest snapshot whose files all stand unchanged and (``before``) whose events are all
    earlier than that seq: a row (snap, buckets), or None."""
    covered = _covered(spark, log)
    if covered.isEmpty():
        return None
    now = log_files(spark, log).drop("path").withColumn("_there", F.lit(True))
    whole = (covered.join(now, SAME, "left").groupBy("snap", "buckets")
             .agg(F.max("made").alias("made"), F.max("last").alias("last"),
                  F.count_if(F.col("_there").isNull()).alias("gone")).filter("gone = 0"))
    if before is not None:
        whole = whole.filter(F.col("last") < before)
    return whole.orderBy(F.desc("made"), "snap").select("snap", "buckets").first()


def uncovered(spark: SparkSession, log: str, schema: T.StructType, snap: str | None) -> DataFrame:
    """The events of the files that a snapshot does not cover (all, without one)."""
    if snap is None:
        return read_if_exists(spark, log, schema)
    fresh = log_files(spark, log).join(_covered(spark, log).filter(F.col("snap") == snap), SAME, "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]  # of the days since then
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact(spark: SparkSession, log: str, fields: list[str], schema: T.StructType, before: int | None = None,
            buckets: int = BUCKETS) -> str | None:
    """Fold the log's events into a new snapshot; its name, or None if there is nothing new.

    ``before`` takes only files whose events are all earlier than that seq. Starts from the
    newest usable snapshot, which is read and written bucket by bucket, without a shuffle.
    ``fields`` and ``buckets`` stay as they were first chosen. No job may write to the log meanwhile.
    """
    old = usable(spark, log, before)
    events = uncovered(spark, log, schema, old and old.snap)
    if not events.inputFiles():
        return None
    new = events.select("seq", *_stamp()).groupBy(*SAME).agg(F.max("seq").alias("last"))
    if before is not None:
        new = new.filter(F.col("last") < before)
    new = new.join(log_files(spark, log), SAME).checkpoint()  # a row per file
    paths = [r.path for r in new.select("path").collect()]
    if not paths:
        return None
    delta = latest(spark.read.schema(schema).parquet(*paths), fields)
    if old:
        buckets = old.buckets
        d = delta.select(F.col(KEY).alias("_case"), *[F.col(f).alias(f"_new_{f}") for f in fields])
        j = stored(spark, log, old.snap, buckets).join(d, F.col(KEY) == F.col("_case"), "full_outer")
        state = j.select(F.coalesce(KEY, "_case").alias(KEY), *[F.greatest(f, f"_new_{f}").alias(f) for f in fields])
    else:
        state = delta.repartition(buckets, KEY)
    snap = uuid.uuid4().hex
    (state.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{_root(log)}/state/{snap}")
     .saveAsTable(f"state_snapshot_{snap}"))
    files = new.select(*SAME, "last")
    if old:
        files = files.unionByName(_covered(spark, log).filter(F.col("snap") == old.snap).select(*SAME, "last"))
    (files.select(F.lit(snap).alias("snap"), *SAME, "last", F.current_timestamp().alias("made"), F.lit(buckets).alias("buckets"))
     .coalesce(1).write.mode("append").parquet(f"{_root(log)}/files"))
    return snap


def with_current(cases: DataFrame, key: str, log: str, fields: list[str], schema: T.StructType,
                 before: int | None = None) -> DataFrame:
    """``cases`` with the current value of each field (replacing columns of that name), by events
    earlier than seq ``before``. The history is neither shuffled nor reduced again: the cases go
    to the snapshot's buckets, and what is reduced is the events it does not cover."""
    spark = cases.sparkSession
    old = usable(spark, log, before)
    events = uncovered(spark, log, schema, old and old.snap)
    if before is not None:
        events = events.filter(F.col("seq") < before)
    j, sides = cases.drop(*fields), [("_new", latest(events, fields))]
    if old:
        sides.insert(0, ("_old", stored(spark, log, old.snap, old.buckets)))
    for name, side in sides:
        side = side.select(F.col(KEY).alias(name), *[F.col(f).alias(f"{name}_{f}") for f in fields])
        j = j.join(side, F.col(key) == F.col(name), "left").drop(name)
    value = lambda f: (F.greatest(f"_old_{f}", f"_new_{f}") if old else F.col(f"_new_{f}"))["value"].alias(f)
    return j.select(*[c for c in cases.columns if c not in fields], *[value(f) for f in fields])
