"""O-49: remittance work-list -> new ledger rows for the run (set at a time)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billflow.operators import remit as R
from billflow.operators.gates import pending_worklist
from billflow.operators.joins import maybe_broadcast
from billflow.operators.lookups import first_by_position
from billflow.schema import REMIT_LEDGER, WL_PROCESSED
from billflow.session import checkpoint_dir
from billflow.sources.commits import publish, read_published

WORKED = T.StructType([T.StructField(c, T.StringType())
                       for c in ("login", "state_name", "practice", "wl_status")])
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("practice", "row_text", "rsm")])


def worked_rows(rows: DataFrame, status: DataFrame) -> DataFrame:
    """The rows of workable practices, with the RSM of the work-list row that is
    worked: the first workable one of the practice. The work-list is config-sized."""
    workable = status.filter(F.col("wl_status") == WL_PROCESSED)
    first = first_by_position(workable, ["practice"], ["position"], ["rsm"])
    return rows.join(maybe_broadcast(first), "practice")


def ledger_delta(rows: DataFrame, status: DataFrame, ledger: DataFrame, inventory: DataFrame,
                 asof: dt.date) -> DataFrame:
    """Ledger rows this run adds: unseen checks of workable practices that the
    search shows, with whether their document arrived. ``status``: the work-list
    with the status of this run (:func:`billflow.operators.remit.worklist_status`)."""
    cand = R.searched(R.remit_candidates(worked_rows(rows, status), asof), asof)
    expected = R.with_doc_name(R.unseen_checks(cand, ledger))
    return R.ledger_rows(R.download_reconcile(expected, inventory))


def todo(worklist: DataFrame, worked: DataFrame | None = None, login: str | None = None) -> DataFrame:
    """Work-list rows of ``login`` (all, if None) without a status, neither their
    own nor one that an earlier run of the day recorded."""
    if "wl_status" not in worklist.columns:
        worklist = worklist.withColumn("wl_status", F.lit(None).cast("string"))
    left = pending_worklist(worklist, login)
    if worked is None:
        return left
    keys = ["login", "state_name", "practice"]
    done = worked.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(maybe_broadcast(done), same, "left_anti")


def read_ledger(spark: SparkSession, ledger_path: str, asof: dt.date) -> DataFrame:
    """The day's published ledger rows."""
    return read_published(spark, ledger_path, asof, "ledger", REMIT_LEDGER)


def read_rejects(spark: SparkSession, ledger_path: str, asof: dt.date) -> DataFrame:
    return read_published(spark, ledger_path, asof, "rejects", REJECTS)


def read_worked(spark: SparkSession, ledger_path: str, asof: dt.date) -> DataFrame:
    """The work-list rows that the day's runs worked, with their status."""
    return read_published(spark, ledger_path, asof, "worklist", WORKED)


def run_remit(spark: SparkSession, rows: DataFrame, worklist: DataFrame, known_states: DataFrame,
              known_practices: DataFrame, inventory: DataFrame, ledger_path: str, asof: dt.date,
              login: str | None = None, run: str | None = None) -> int:
    """Work the pending work-list rows: the new checks for the day's ledger, the rows
    that do not parse for its rejects and each worked row's status are published
    together (:mod:`billflow.sources.commits`); return the number of new ledger rows.

    The delta is checkpointed in shared storage before it is staged, so what is written
    does not depend on the ledger that it was compared with. Of a run that dies before
    its manifest is written nothing is seen, and running it again does all of it.
    """
    checkpoint_dir(spark)
    pending = todo(worklist, read_worked(spark, ledger_path, asof), login)
    if pending.isEmpty():
        return 0
    status = R.worklist_status(pending, known_states, known_practices, rows, asof).checkpoint()
    seen = Observation()
    delta = ledger_delta(rows, status, read_ledger(spark, ledger_path, asof), inventory, asof).checkpoint()
    rejects = R.parse_rejects(worked_rows(rows, status)).select(*REJECTS.names)
    publish(spark, ledger_path, asof, run or uuid.uuid4().hex, {
        "ledger": delta.observe(seen, F.count(F.lit(1)).alias("n")), "rejects": rejects,
        "worklist": status.select(*WORKED.names)})
    return int(seen.get["n"])
