"""Incremental twins of the landing-folder and ledger operators.

The source polls a folder until a new export appears, then processes it.
Here the folder is a Structured Streaming file source: its checkpoint is the
"files already seen" set, so each ``AvailableNow`` run picks up exactly the
files that arrived since the last one (O-04), and survives restarts and lost
executors through the checkpoint and replayable file offsets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from billflow.operators import remit as R
from billflow.sources.commits import publish, read_published
from billflow.schema import NA_TOKENS, REMIT_LEDGER


def text_export_stream(spark: SparkSession, folder: str, columns: list[str],
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of CSV exports (all columns text, NA tokens -> NULL), with the
    source file of each row; quoted cells may hold line breaks and doubled quotes, as
    in the batch scan (:func:`billflow.sources.files.read_text_table`)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
         .option("multiLine", True).option("escape", '"'))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(folder)
    na = list(NA_TOKENS)
    cleaned = [F.when(F.col(f"`{c}`").isin(na), None).otherwise(F.col(f"`{c}`")).alias(c)
               for c in columns]
    return df.select(*cleaned, F.col("_metadata.file_path").alias("source_file"))


def land_new_exports(spark: SparkSession, folder: str, columns: list[str], out_path: str,
                     checkpoint: str) -> StreamingQuery:
    """Append the rows of every export that arrived since the last run, then stop."""
    q = (text_export_stream(spark, folder, columns).writeStream
         .format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def ledger_sink(ledger_path: str, asof: dt.date, query: str = "stream"):
    """``foreachBatch`` sink: publish only checks not yet in the day's ledger.

    A micro-batch is one run of the ledger's commits, named by the query and the
    batch: replayed after a failure it is published once, and what a dead attempt
    staged is not read.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = read_published(spark, ledger_path, asof, "ledger", REMIT_LEDGER)
        fresh = R.unseen_checks(batch, seen, dedupe=True)
        publish(spark, ledger_path, asof, f"{query}-{batch_id}",
                {"ledger": fresh.select(*[f.name for f in REMIT_LEDGER.fields])})

    return write


def dedupe_checks_stream(rows: DataFrame, event_time: str = "arrived_at",
                         delay: str = "1 day") -> DataFrame:
    """Streaming O-33: one row per check number within the watermark delay."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["check_no"])
