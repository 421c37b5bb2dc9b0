"""Mixing sources to target weights; DataFrame functions only.

Sizes (words) are summed per source. The sources, in code point order with null
last, weigh 5, 2, 1, 5, 2, 1 ...; they share the whole of all sizes by weight,
but none more than ``MOST`` times its own size: what is cut off is shared again
by weight until none is above (water-filling). Sorted by size over weight, the
capped sources come first, so one pass of running sums finds the common level.

Sources are as many as there are: ranks and running sums are taken in sorted ranges of
them, each from what the ranges before it add up to (``running``), so no task holds all.

A source's repetition rate is its target over its size. Each document is taken
floor(rate) times, and once more with probability equal to the fraction. The draw is a
hash of the seed, the id and the text, so it is the same in every run, and rows that
share an id (or have none) are drawn on their own if their texts differ. Rows equal in
id, source and text are numbered, and the number spreads them evenly over the unit
interval (a golden-ratio sequence from the hash), so that of however many copies of one
row the fraction is taken. Only such rows are shuffled; what they have in common is
counted map-side, and they are numbered within the partitions that they come from.

Documents meet their source's rate in a broadcast while the sources are few (checked),
else in a join by source with the documents salted.

Defined results: a null text has size 0; a null source is a source of its own,
last; a source of size 0 has target 0 and its documents are not taken; rows equal in
id, source and text may swap their copies between runs, never their number; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billflow.operators.joins import broadcast_row_limit, maybe_broadcast

from .common import SPACE, cut, unit_hash

WEIGHTS, MOST, SEED, SALTS, RANGE = (5, 2, 1), 3, 5, 32, 1_000_000
GOLDEN = 0.6180339887498949


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each of ``sums``, its total over the rows before; rows in ``order`` (unique).

    Rows are sorted in ranges of about ``RANGE``. Only one row per range, its totals, is
    summed in one place; within a range the sums run on from there.
    """
    ranges = max(1, -(-df.count() // RANGE))
    dealt = cut(df.withColumns({f"_{n}": c for n, c in sums.items()}).repartitionByRange(ranges, *order)
                .withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy(F.col("_range").alias("_of")).agg(*[F.sum(f"_{n}").alias(f"_all_{n}") for n in sums]).select(
        "_of", *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_ahead_{n}") for n in sums])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    both = dealt.join(F.broadcast(ahead), F.col("_range") == F.col("_of"))
    return both.select(*df.columns, *[(F.col(f"_ahead_{n}") + F.coalesce(F.sum(f"_{n}").over(within), F.lit(0))).alias(n) for n in sums])


def targets(docs: DataFrame, source_col: str = "source", size_col: str = "size",
            weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source."""
    by_source = cut(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size")))
    named = [F.col("source").isNull().asc(), F.col("source").asc()]
    cycle = F.array(*[F.lit(w) for w in weights])
    s = running(by_source, named, {"place": F.lit(1)})
    s = s.select("source", "source_size", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("w"))
    # capped sources come first in this order; level: what the rest would get per weight
    order = [(F.col("source_size") / F.col("w")).asc(), *named]
    s = cut(running(s, order, {"k": F.lit(1), "size_before": F.col("source_size"), "w_before": F.col("w")}))
    whole = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"), F.coalesce(F.sum("w"), F.lit(0)).alias("w_all")).first()
    level = (whole.total - most * F.col("size_before")).cast("double") / (whole.w_all - F.col("w_before"))
    s = s.withColumn("level", level)
    first = s.filter(F.col("level") * F.col("w") <= most * F.col("source_size")).agg(F.min(F.struct("k", "level")).alias("x")).first().x
    common = F.lit(first.level if first else None).cast("double")
    return s.select("source", "source_size",
                    F.least((most * F.col("source_size")).cast("double"), F.col("w") * common).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep`` (the id alone), size, source_size, target, copies."""
    kept = keep or [id_col]
    read = df.select(F.struct(*[F.col(c) for c in kept]).alias("row"), F.col(id_col).cast("string").alias("id"),
                     F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
                     F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("print"))
    same = F.xxhash64("id", "source", "print")
    small = cut(read.select("source", "size", same.alias("same"), F.spark_partition_id().alias("part")))
    to = cut(targets(small, weights=weights, most=most).withColumnRenamed("source", "of"))
    docs = _numbered(read.withColumn("same", same), small)
    if to.count() <= broadcast_row_limit(to):
        both = docs.join(F.broadcast(to), F.col("source").eqNullSafe(F.col("of")))
    else:
        salted = to.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("to_salt"))
        both = docs.withColumn("salt", F.pmod(F.xxhash64("print"), F.lit(SALTS)).cast("int")).join(
            salted, (F.col("salt") == F.col("to_salt")) & F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    turned = unit_hash("id", "print", seed=seed) + F.col("number") * F.lit(GOLDEN)
    copies = F.floor(rate) + F.when(turned - F.floor(turned) < rate - F.floor(rate), 1).otherwise(0)
    return both.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def _numbered(docs: DataFrame, small: DataFrame) -> DataFrame:
    """``docs`` with ``number``: 0, 1, 2 ... among the rows equal in id, source and text.

    ``small`` has the same rows' key (``same``) and partition, in few bytes. Where no key
    stands twice, all are 0. Else the rows of such keys are numbered within each partition
    that holds some, onwards from the count of those in the partitions before.
    """
    counts = small.groupBy("same", "part").agg(F.count("*").alias("n"))
    repeats = cut(counts.groupBy("same").agg(F.sum("n").alias("all")).filter(F.col("all") > 1))
    if repeats.isEmpty():
        return docs.withColumn("number", F.lit(0).cast("bigint"))
    # unique keys, so no row is doubled; broadcast while they are few, and else salted as a hot key can be any
    salted = repeats.select(F.col("same").alias("_same"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_to"))
    lot = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    hit = cut(docs.withColumn("part", F.spark_partition_id()).withColumn("_lot", lot).join(
        maybe_broadcast(salted), (F.col("same") == F.col("_same")) & (F.col("_lot") == F.col("_to")), "left"))
    once = hit.filter("_same is null").withColumn("number", F.lit(0).cast("bigint"))
    again = hit.filter("_same is not null")
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = (again.groupBy(F.col("same").alias("_key"), F.col("part").alias("_part")).agg(F.count("*").alias("_n"))
             .select("_key", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    place = F.row_number().over(Window.partitionBy("same", "part").orderBy(F.lit(1)))
    numbered = again.withColumn("_place", place).join(
        start, (F.col("same") == F.col("_key")) & (F.col("part") == F.col("_part"))).withColumn(
        "number", (F.col("_start") + F.col("_place") - 1).cast("bigint"))
    return once.select(*docs.columns, "number").unionByName(numbered.select(*docs.columns, "number"))


def take(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: int = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``df``, all columns, each as often as it is taken."""
    mixed = mix(df, id_col, text_col, source_col, seed, keep=df.columns)
    return (mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("row.*"))
