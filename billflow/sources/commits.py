"""Atomic commits of several tables (O-49): staged files, published by one manifest per run.

A run writes each table to a folder of its own below ``_data``, where no reader looks.
Only then it writes its manifest, one row per table in one file: Spark's commit makes that
file visible in one rename, so the run's tables appear all together or not at all. Readers
take the manifests of a day and read the folders that these name. What a dead run left
staged is never read; the run is simply run again, under an id of its own, or under the
same id, which is published once (a replayed micro-batch). Paths in a manifest are
relative, so a whole store can be moved. Runs of one day follow each other: two at once
would each not see the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from billflow.sources.files import read_if_exists

MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("run", "table", "path")])


def day_key(asof: dt.date) -> str:
    return f"run_date={asof.strftime('%m%d%Y')}"


def manifests(spark: SparkSession, root: str, asof: dt.date) -> list:
    """What the day's runs published: a row per run and table."""
    return read_if_exists(spark, f"{root.rstrip('/')}/_commits/{day_key(asof)}", MANIFEST).collect()


def stage(df: DataFrame, root: str, path: str) -> None:
    """Write one table of a run where no reader looks; a rerun under the same id replaces it."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{path}")


def _announce(spark: SparkSession, root: str, asof: dt.date, rows: list[tuple[str, str, str]]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/_commits/{day_key(asof)}")


def publish(spark: SparkSession, root: str, asof: dt.date, run: str, tables: dict[str, DataFrame]) -> bool:
    """Make the run's tables readable, all at once; False (nothing written) if the run is published already."""
    if any(m.run == run for m in manifests(spark, root, asof)):
        return False
    rows = [(run, name, f"_data/{day_key(asof)}/{run}/{name}") for name in tables]
    for _, name, path in rows:
        stage(tables[name], root, path)
    _announce(spark, root, asof, rows)
    return True


def read_published(spark: SparkSession, root: str, asof: dt.date, table: str, schema: T.StructType) -> DataFrame:
    """The table's rows of all runs that the day published."""
    paths = [f"{root.rstrip('/')}/{m.path}" for m in manifests(spark, root, asof) if m.table == table]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
