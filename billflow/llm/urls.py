"""URL filters by a temporal list join; DataFrame functions only.

A list is a log of dated entries: from its day on, an entry adds a key to a list
or takes it off. A key's entries become validity intervals, from the entry that
adds it to the key's next entry. A capture is evaluated against what was active
on the day it was fetched: the most specific of its keys that was listed then
decides, and on a tie an allowance goes before a block.

Keys of a capture are its host and the host's parent domains. The as-of join is
an equi-join on (key, period): an interval is dealt to those periods it covers in
which the key has captures, so that neither a far date nor an open end makes rows;
time only decides within a period. Periods and a salt split a hot host's captures;
the intervals, which are few, are repeated for the salts. Intervals of one list and
key do not overlap, so a capture meets at most one of each, and what it meets is
folded before the result goes back to its row; rows are salted there, too.

Defined results: a capture without a host or day (null, or a URL that has none)
meets nothing and is not blocked; entries with a null list, key or day are
ignored; days are whole numbers of any size and sign;
of entries for one list, key and day a removal wins; repeated rows each
get a result; an empty list blocks nothing; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billflow.operators.joins import unique_left_join

from .lines import host_of

PERIOD_DAYS, SALTS = 64, 8


def keys_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, day, adds) -> (list, key, since, until): until is the first day it holds no more, or null."""
    one = (entries.filter("list is not null and key is not null and day is not null")
           .groupBy("list", "key", "day").agg(F.min(F.coalesce("adds", F.lit(False))).alias("adds")))
    after = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return one.withColumn("until", after).filter("adds").select("list", "key", F.col("day").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, day_col: str) -> DataFrame:
    """Per capture: id, host, day, n_active (entries that held), decided_by (the key, or null), blocked."""
    seen = captures.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), F.col(day_col).alias("day"))
    period = lambda day: F.floor(day.cast("long") / PERIOD_DAYS)
    # a host and day decide alike: fold them first, then the join meets each once per salt
    asked = (seen.filter("host is not null and day is not null")
             .groupBy("host", F.col("day").cast("long").alias("day")).agg(F.count("*").alias("captures")))
    keyed = asked.select("host", "day", period(F.col("day")).alias("period"),
                         F.pmod(F.xxhash64("host", "day"), F.lit(SALTS)).cast("int").alias("salt"),
                         F.explode(keys_of(F.col("host"))).alias("key"))
    there = keyed.select(F.col("key").alias("of"), "period").distinct()
    held = intervals(entries.withColumn("day", F.col("day").cast("long")))
    held = (held.join(there, (F.col("key") == F.col("of")) & (F.col("period") >= period(F.col("since")))
                      & (F.col("until").isNull() | (F.col("period") <= period(F.col("until") - 1))))
            .select("list", "key", "since", "until", "period", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    met = (keyed.join(held, ["key", "period", "salt"])
           .filter((F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))))
    rank = F.struct(F.length("key").alias("len"), (F.col("list") == "allow").alias("allow"), F.col("key").alias("key"))
    verdict = met.groupBy(F.col("host").alias("of_host"), F.col("day").alias("of_day")).agg(
        F.count("*").alias("n_active"), F.max(rank).alias("top"))
    told = unique_left_join(seen, verdict, [(F.col("host"), "of_host"), (F.col("day").cast("long"), "of_day")], "id")
    return told.select(F.col("id").alias(id_col), "host", F.col("day").alias(day_col),
                       F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                       F.col("top.key").alias("decided_by"),
                       F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"))
