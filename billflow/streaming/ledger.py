"""O-33 as a stream with state: a day's checks are looked up in state, not in the day's whole ledger.

The state holds one entry per (run date, check number) that the ledger has. A query's first
start fills it from the ledger as it stands; from then on a micro-batch costs what its own rows
cost, however long the day's ledger has become. The checkpoint carries the state over restarts.

A run date closes once a run date ``keep_days`` or more later has been read: its
entries are cleared by a timer, and rows that still come for it are dropped as late, since the state
could no longer tell which were seen. Such a day is run again with the batch job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from billflow.schema import REMIT_LEDGER
from billflow.sources.commits import publish

FIELDS = [f.name for f in REMIT_LEDGER.fields]
ROW = ", ".join(["run_date date", *[f"{c} string" for c in FIELDS]])
DAY_MS = 86_400_000


def _least(rows: pd.DataFrame) -> pd.DataFrame:
    """Of rows with the same date and check the least by content, so that a replay takes the same one."""
    return rows.sort_values(FIELDS, na_position="first").drop_duplicates(["run_date", "check_no"])


class SeenChecks(StatefulProcessor):
    """State of one (run date, check number): there is an entry once the ledger has the check."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "yes boolean")

    def _enter(self, day: dt.date) -> None:
        self.seen.update((True,))
        # the watermark reaches the date as soon as rows of it are late
        self.handle.registerTimer((day - dt.date(1970, 1, 1)).days * DAY_MS)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        if key[1] is not None and not self.seen.exists():
            self._enter(key[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        best = None
        for part in rows:  # one row is held, however many there are
            part = part[["run_date", *FIELDS]]
            best = _least(part if best is None else pd.concat([best, part]))
        if key[1] is not None:  # a row without a number is no check that was seen
            self._enter(key[0])
        if best is not None:
            yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def unseen_stream(rows: DataFrame, ledger: DataFrame, keep_days: int = 2) -> DataFrame:
    """The rows of a stream (``run_date`` and the ledger's columns) whose check that day's ledger lacks, one per check.

    ``ledger`` (``run_date`` and ``check_no``) starts the state; repeats in it are as good as one. Rows
    without a check number are never seen: one of them passes in each micro-batch, as in the batch
    operator; rows without a run date are dropped. Repeats are cut per Arrow batch before
    the shuffle, so a check that fills a third of the stream reaches its task as a few rows.
    """
    few = (rows.select(F.col("run_date").cast("date").alias("run_date"), *FIELDS).filter("run_date is not null")
           .mapInPandas(lambda parts: (_least(p) for p in parts), ROW)
           .withColumn("day", F.col("run_date").cast("timestamp")).withWatermark("day", f"{keep_days} days"))
    start = (ledger.select(F.col("run_date").cast("date").alias("run_date"), "check_no")
             .filter("run_date is not null and check_no is not null").distinct().groupBy("run_date", "check_no"))
    return few.groupBy("run_date", "check_no").transformWithStateInPandas(
        SeenChecks(), ROW, "append", "EventTime", start)


def land_unseen(rows: DataFrame, ledger: DataFrame, root: str, checkpoint: str, query: str = "unseen",
                keep_days: int = 2) -> StreamingQuery:
    """Publish the unseen checks of all that has arrived to the ledgers of their run dates, then stop.

    A micro-batch is one run of each date's ledger, named by the query and the batch: replayed after a
    failure it is published once, and what a dead attempt staged is not read.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for r in batch.select("run_date").distinct().orderBy("run_date").collect():  # open dates, a few
                fresh = batch.filter(F.col("run_date") == F.lit(r.run_date)).select(*FIELDS)
                publish(batch.sparkSession, root, r.run_date, f"{query}-{batch_id}", {"ledger": fresh})
        finally:
            batch.unpersist()

    q = (unseen_stream(rows, ledger, keep_days).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
