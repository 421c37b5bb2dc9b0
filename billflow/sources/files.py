"""Landing-zone sources and sinks (O-01, O-04 .. O-09, O-06, O-10 .. O-12)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billflow.schema import EXPORT_HEADERS, NA_TOKENS
from billflow.session import checkpoint_dir


CSV_OPTIONS = {"mode": "PERMISSIVE", "multiLine": True, "escape": '"'}


# ---- O-01 text scan ---------------------------------------------------------------

def read_text_table(spark: SparkSession, path: str, columns: list[str] | None = None,
                    schema: T.StructType | None = None) -> DataFrame:
    """CSV export with every column read as text; pandas' NA tokens become NULL.

    Quoted cells may hold line breaks and doubled quotes, as spreadsheets write
    them. A file is read by one task; :mod:`billflow.sources.splits` reads a large one by many.
    No schema inference (one pass, no sampling job). Spark's ``nullValue``
    takes a single token, so the remaining tokens are mapped in one projection.
    """
    if schema is None and columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.read.options(header=True, **CSV_OPTIONS)
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    return na_to_null(df, df.columns)


def na_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """pandas' NA tokens -> NULL in ``cols``, in one projection."""
    na = list(NA_TOKENS)
    token = lambda c: F.when(F.col(f"`{c}`").isin(na), None).otherwise(F.col(f"`{c}`")).alias(c)
    return df.select([token(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def write_text_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---- O-06 / O-10 / O-11 / O-12 header and column shaping ----------------------------

def strip_headers(df: DataFrame) -> DataFrame:
    """Trim header names; blank headers are dropped."""
    keep = [(c, c.strip()) for c in df.columns if c.strip()]
    return df.select([F.col(f"`{c}`").alias(n) for c, n in keep])


def rename_to_canonical(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename export headers to canonical snake_case names (O-10)."""
    mapping = mapping or EXPORT_HEADERS
    return df.select([F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def add_missing_columns(df: DataFrame, wanted: list[str], dtype: str = "string") -> DataFrame:
    """Append each wanted column that is absent, as NULL (present ones untouched)."""
    missing = [c for c in wanted if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(dtype) for c in missing}) if missing else df


def null_to_empty(df: DataFrame) -> DataFrame:
    """NULL -> '' in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=strings)


# ---- O-04 / O-05 file inventory --------------------------------------------------------

def file_inventory(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, modificationTime, length) of the files in a folder.

    ``binaryFile`` with the ``content`` column pruned never opens the files;
    only the listing is read. Zero-byte files are not listed (Spark's file scan
    skips them), so an empty download counts as not downloaded.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(folder))
    return df.select("path", "modificationTime", "length")


def new_arrivals(now: DataFrame, before: DataFrame, suffix: str | None = None) -> DataFrame:
    """Files listed now but not at the previous poll (set difference on path)."""
    fresh = now.join(before.select(F.col("path").alias("_before_path")),
                     F.col("path") == F.col("_before_path"), "left_anti")
    return fresh.filter(F.col("path").endswith(suffix)) if suffix else fresh


def latest_arrival(inv: DataFrame, by: list[str] | None = None,
                   suffix: str | None = None) -> DataFrame:
    """Newest file (max modificationTime, then max path) overall or per group."""
    if suffix:
        inv = inv.filter(F.col("path").endswith(suffix))
    pick = F.max_by(F.struct("path", "modificationTime", "length"),
                    F.struct("modificationTime", "path")).alias("_latest")
    g = inv.groupBy(*by) if by else inv.groupBy()
    return g.agg(pick).select(*(by or []), "_latest.path", "_latest.modificationTime",
                              "_latest.length")


def folder_of(path_col: str = "path") -> F.Column:
    """Parent folder of a path."""
    return F.regexp_extract(F.col(path_col), r"^(.*)/[^/]*$", 1)


# ---- O-07 / O-08 dated layout and three-way sink -------------------------------------------

def run_partition_columns(asof: dt.date) -> dict[str, F.Column]:
    """Year / month / day folder keys of a run."""
    return {"run_year": F.lit(asof.strftime("%Y")),
            "run_month": F.lit(asof.strftime("%m %b'%Y")),
            "run_date": F.lit(asof.strftime("%m%d%Y"))}


def _escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^" else c for c in value)


def run_folder(path: str, asof: dt.date) -> str:
    """The folder of one run: run_year=.../run_month=.../run_date=..."""
    keys = {"run_year": asof.strftime("%Y"), "run_month": asof.strftime("%m %b'%Y"),
            "run_date": asof.strftime("%m%d%Y")}
    return "/".join([path.rstrip("/"), *(f"{k}={_escaped(v)}" for k, v in keys.items())])


def write_run(df: DataFrame, path: str, asof: dt.date, fmt: str = "parquet",
              extra_partitions: list[str] | None = None) -> None:
    """Write one run's output under its year/month/day folder.

    The run's whole folder is replaced, so a rerun leaves nothing of an earlier
    run of the day behind, also where its output (or a route of it) is empty now;
    other days are untouched.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if extra_partitions:
        w = w.partitionBy(*extra_partitions)
    w.save(run_folder(path, asof))


def clear_run(spark: SparkSession, path: str, asof: dt.date) -> None:
    """Replace the run's folder by an empty one (a day without input)."""
    none = spark.createDataFrame([], "none string, part string")
    write_run(none, path, asof, extra_partitions=["part"])


def write_routes(tagged: DataFrame, path: str, asof: dt.date) -> None:
    """O-08: the exception / manual / straightforward outputs of one run in one
    write, split by the ``route`` column into sibling folders."""
    write_run(tagged, path, asof, extra_partitions=["route"])


PARTITION_TEXT_COLS = ("run_year", "run_month", "run_date", "route")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs, with folder keys kept as text ('01052026' must not become 1052026)."""
    inferred = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in PARTITION_TEXT_COLS
                           else f for f in inferred.fields])
    return spark.read.schema(schema).parquet(path)


def read_run(spark: SparkSession, path: str, asof: dt.date, route: str | None = None) -> DataFrame:
    """Read one run back; the date literals prune to that run's folders."""
    df = read_runs(spark, path)
    keys = run_partition_columns(asof)
    cond = (F.col("run_date") == keys["run_date"]) & (F.col("run_year") == keys["run_year"])
    if route:
        cond = cond & (F.col("route") == route)
    return df.filter(cond)


# ---- O-09 create-or-resume ----------------------------------------------------------------

def seed_or_resume(existing: DataFrame | None, seed: DataFrame, key: list[str]) -> DataFrame:
    """Today's work table: existing rows kept as they are, plus seed rows for
    keys not yet present (blank state). With no existing table, the seed."""
    if existing is None:
        return seed
    fresh = seed.join(existing.select(*key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def missing_path(e: AnalysisException) -> bool:
    """Whether the error says that a path is not there (or holds no data file yet)."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a parquet table, or an empty one of ``schema`` when its path is absent.

    Any other failure (permissions, storage) is raised: taking it for "no ledger"
    would admit again what the ledger already holds.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)


def read_run_or_none(spark: SparkSession, path: str, asof: dt.date,
                     route: str | None = None) -> DataFrame | None:
    """One run's output without its folder keys; None when there is none or it is empty."""
    try:
        df = read_run(spark, path, asof, route).drop("run_year", "run_month", "run_date")
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return None
    return None if df.isEmpty() else df
