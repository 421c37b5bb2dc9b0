"""Remittance (EOB) reconciliation (O-19 .. O-21, O-29b, O-33, O-36, O-47)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.functions.nulls import match_or_false
from billflow.functions.text import doc_name, path_tail, sanitise, split_lines, strip_ws
from billflow.operators.gates import date_window
from billflow.operators.joins import maybe_broadcast
from billflow.schema import (FILE_DOWNLOADED, FILE_NOT_DOWNLOADED, WL_NO_EOBS,
                             WL_PRACTICE_NOT_FOUND, WL_PROCESSED, WL_STATE_NOT_FOUND, WL_UNMATCHED)

REMIT_FIELDS = ("check_no", "payer", "payee", "check_date", "received_date", "amount")


def parse_remit_row(df: DataFrame, text: str = "row_text") -> DataFrame:
    """O-19: split the six-line row text into fields.

    A row with fewer than six lines gets NULL for the missing fields and
    ``parse_ok`` false (the source would stop with an index error).

    The split text is the output of a one-element ``explode``. The optimiser merges
    projections, and pushes filters, only down to a generator, so the text is built
    and split once per row however many fields are read or tested above it.
    """
    parts = F.col("_parts")
    fields = {f: F.try_element_at(parts, F.lit(i + 1)) for i, f in enumerate(REMIT_FIELDS)}
    split = df.withColumn("_parts", F.explode(F.array(split_lines(F.col(text)))))
    return split.withColumns({**fields, "parse_ok": F.size(parts) >= len(REMIT_FIELDS)}).drop("_parts")


def sanitise_names(df: DataFrame, cols=("payer", "payee")) -> DataFrame:
    """O-20: strip file-name-hostile characters from payer and payee."""
    return df.withColumns({c: sanitise(F.col(c)) for c in cols})


def remit_window(df: DataFrame, asof: dt.date) -> DataFrame:
    """O-29b: received or check date is asof or the day before."""
    return date_window(df, ("received_date", "check_date"), asof, days=2)


def searched(df: DataFrame, asof: dt.date) -> DataFrame:
    """What the portal's search shows: rows whose check date is asof or the day before."""
    return date_window(df, ("check_date", "check_date"), asof, days=2)


def unseen_checks(df: DataFrame, ledger: DataFrame, dedupe: bool = False) -> DataFrame:
    """O-33: drop checks already in the run's ledger (any status).

    The seen-list is the ledger as read at the start of the run, so repeats
    inside one batch pass; ``dedupe=True`` also keeps one row per check. The
    ledger is not reduced first: both sides of the join are then plain shuffles,
    whose hot partitions AQE splits.
    """
    seen = ledger.select(F.col("check_no").alias("_seen"))
    out = df.join(seen, F.col("check_no") == F.col("_seen"), "left_anti")
    return out.dropDuplicates(["check_no"]) if dedupe else out


def with_doc_name(df: DataFrame) -> DataFrame:
    """O-21: expected document name check_payer_payee_amount.pdf."""
    return df.withColumn("doc_name", doc_name(F.col("check_no"), F.col("payer"),
                                              F.col("payee"), F.col("amount")))


def download_reconcile(expected: DataFrame, inventory: DataFrame) -> DataFrame:
    """O-36: 'File Downloaded' when a file of the expected name exists."""
    names = inventory.select(path_tail(F.col("path")).alias("_file")).distinct()
    j = expected.join(names, F.col("doc_name") == F.col("_file"), "left")
    return j.withColumn("status", F.when(F.col("_file").isNotNull(), F.lit(FILE_DOWNLOADED))
                        .otherwise(F.lit(FILE_NOT_DOWNLOADED))).drop("_file")


def ledger_rows(reconciled: DataFrame) -> DataFrame:
    """The 7-column ledger rows; ``rsm`` comes from the work-list row that was worked."""
    return reconciled.select("check_no", "payer", "payee", "check_date", "amount", "status", "rsm")


def worklist_status(worklist: DataFrame, known_states: DataFrame, known_practices: DataFrame,
                    rows: DataFrame, asof: dt.date) -> DataFrame:
    """O-47: status of each work-list row.

    No such state offered -> 'State Not found'; a state offered that is not
    spelled as asked -> 'Unmatched'; practice not offered -> 'Practice name not
    found'; no check dated in the searched days -> 'No EOBs'; otherwise
    'Processed'. Rows are counted once per practice, combined map-side.
    """
    shown = parse_remit_row(rows)
    days = [(asof - dt.timedelta(days=i)).strftime("%m/%d/%Y") for i in range(2)]
    per_practice = shown.groupBy("practice").agg(
        F.count_if(match_or_false(F.col("check_date").isin(days))).alias("_n_shown"))
    fold = lambda c: F.lower(strip_ws(c))
    states = known_states.groupBy(fold(F.col("state_name")).alias("_folded")).agg(
        F.collect_set("state_name").alias("_spelled"))  # the few spellings of one state
    practices = known_practices.select(F.col("practice").alias("_practice")).distinct()
    j = (worklist.join(maybe_broadcast(states), fold(F.col("state_name")) == F.col("_folded"), "left")
         .join(maybe_broadcast(practices), F.col("practice") == F.col("_practice"), "left")
         .join(per_practice, "practice", "left"))
    status = (F.when(F.col("_folded").isNull(), F.lit(WL_STATE_NOT_FOUND))
              .when(~F.array_contains("_spelled", strip_ws(F.col("state_name"))), F.lit(WL_UNMATCHED))
              .when(F.col("_practice").isNull(), F.lit(WL_PRACTICE_NOT_FOUND))
              .when(F.coalesce(F.col("_n_shown"), F.lit(0)) == 0, F.lit(WL_NO_EOBS))
              .otherwise(F.lit(WL_PROCESSED)))
    return j.withColumn("wl_status", status).select(
        *worklist.columns, *([] if "wl_status" in worklist.columns else ["wl_status"]))


def remit_candidates(rows: DataFrame, asof: dt.date) -> DataFrame:
    """Parsed, sanitised rows in the date window (well-formed rows only)."""
    parsed = sanitise_names(parse_remit_row(rows)).filter("parse_ok")
    return remit_window(parsed, asof)


def parse_rejects(rows: DataFrame) -> DataFrame:
    """Rows whose text does not have six fields (reported, not dropped silently)."""
    return parse_remit_row(rows).filter(~match_or_false(F.col("parse_ok")))
