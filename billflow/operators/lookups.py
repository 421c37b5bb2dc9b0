"""Keyed lookups and matches (O-30 .. O-36).

"First in list order" is an aggregate, not a window: ``min(struct(position,
…))`` per key is combined map-side, so a key that holds a third of all rows
is pre-aggregated before the shuffle instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.functions.text import recode_contains
from billflow.operators.joins import null_safe_left_join, unique_left_join


def first_by_position(df: DataFrame, keys: list[str], order: list[str],
                      values: list[str]) -> DataFrame:
    """One row per ``keys``: the values of the row with the smallest ``order``.

    Ties on ``order`` are broken by the values themselves, so the result is
    deterministic. Runs as a partial + final aggregate (skew-safe).
    """
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(f"_v{i}") for i, c in enumerate(values)]
    packed = F.min(F.struct(*fields)).alias("_first")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"_first._v{i}").alias(c) for i, c in enumerate(values)]))


# ---- O-30a payor lookup --------------------------------------------------------

def payor_lookup(cases: DataFrame, clients: DataFrame, dup: str = "fanout",
                 case_key: str = "client_id", client_key: str = "client_id",
                 payor_col: str = "payor", out_col: str = "payor_name") -> DataFrame:
    """Left lookup of each case's payor.

    ``dup='fanout'``: NULL key matches NULL key and duplicate client rows
    multiply the case (the source's merge). ``dup='first'``: one payor per
    client, the one with the smallest ``position``.
    """
    dim = clients.select(F.col(client_key).alias("_lk_key"), F.col(payor_col).alias(out_col),
                         *(["position"] if "position" in clients.columns else []))
    if dup == "first":
        dim = first_by_position(dim, ["_lk_key"], ["position"], [out_col])
        # one row per key, NULL included: a stand-in for NULL makes it a plain equality
        whole = lambda c: F.coalesce(c, F.lit("\0"))
        dim = dim.select(whole(F.col("_lk_key")).alias("_lk_key"), out_col)
        salt = "item_id" if "item_id" in cases.columns else case_key
        return unique_left_join(cases, dim, [(whole(F.col(case_key)), "_lk_key")], salt).drop("_lk_key")
    dim = dim.select("_lk_key", out_col)
    return null_safe_left_join(cases, dim, case_key, "_lk_key").drop("_lk_key")


def recode_payor(df: DataFrame, col: str = "payor_name") -> DataFrame:
    """O-13 applied to the payor column."""
    return df.withColumn(col, recode_contains(F.col(col)))


# ---- O-31 dimension key checks --------------------------------------------------

def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a master table (with their count)."""
    return (dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def duplicate_master_keys(masters: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(master, key, n_rows) of all masters' keys that occur more than once, in one pass."""
    parts = [df.select(F.lit(name).alias("master"), F.col(key).cast("string").alias("key")) for name, (df, key) in masters.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("master", "key").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


class BadMasters(ValueError):
    """Master tables that the source would not work with: keys listed twice, or missing."""


NAMED = 20  # keys that the error names


def validate_masters(masters: dict[str, tuple[DataFrame, str]], missing: DataFrame | None = None) -> None:
    """O-31, enforced: raise :class:`BadMasters` if any master lists a key twice, or if
    ``missing`` (master, key of what no master has) holds a row.

    One job over all masters and the missing keys; only the first ``NAMED`` reach the
    driver. To be called before anything is written.
    """
    bad = duplicate_master_keys(masters).select("master", "key", F.lit("twice").alias("what"))
    if missing is not None:
        bad = bad.unionByName(missing.select("master", "key", F.lit("missing").alias("what")).distinct())
    rows = bad.orderBy("what", "master", "key").limit(NAMED).collect()
    if rows:
        raise BadMasters("provider masters: " + "; ".join(f"{r.master}: {r.key!r} {r.what}" for r in rows))


def missing_master(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key has no master entry (NULL keys count as missing)."""
    d = dim.select(F.col(dim_key).alias("_mm_key"))
    return facts.join(d, F.col(fact_key) == F.col("_mm_key"), "left_anti")


def assert_no_missing(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> None:
    """Strict mode: fail the run when any master entry is missing."""
    if not missing_master(facts, fact_key, dim, dim_key).isEmpty():
        raise ValueError(f"master table lacks entries for some '{fact_key}' values")
