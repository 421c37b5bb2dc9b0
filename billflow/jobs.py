"""Daily jobs: one entry point per stage of the work-queue.

    python -m billflow.jobs scrub    --attendance A.csv --clients C.csv --rules R.csv --out OUT --asof 2026-11-30
    python -m billflow.jobs casework --scrubbed OUT --registry G --lines L --coverage V --invoices I
                                     --outcomes O --rules R.csv --by-payor P --by-staff S
                                     --by-staff-private SP --state STATE --out CASES --asof 2026-11-30
    python -m billflow.jobs claims   --casework CASES --by-staff-private SP --state STATE --out CLAIMS
                                     --asof 2026-11-30
    python -m billflow.jobs submit   --claims CLAIMS --outcomes O --state STATE --asof 2026-11-30
    python -m billflow.jobs annotate --claims CLAIMS --invoices I --state STATE --out NOTES --asof 2026-11-30
    python -m billflow.jobs remit    --rows T --worklist WL --states ST --practices PR --documents DIR
                                     --ledger LEDGER [--login L] --asof 2026-11-30

Inputs may be CSV exports (human headers, every column text) as a file or a folder, or
parquet. Outputs are parquet in year/month/day folders; a rerun of a day replaces its
folders. Each stage reads the previous stage's written output, which keeps lineage short
and lets a failed stage be re-run on its own. STATE is an append-only log of events
(case_id, seq, field, value), one folder per day and stage; a stage leaves alone what the
log says is done. Case ids are hashes of what identifies a case, so they do not depend on
how the export's files are split.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billflow.operators import claims as CL
from billflow.operators import gates as GT
from billflow.operators import lookups as LK
from billflow.operators import matching as M
from billflow.plans import casework as CW
from billflow.plans import scrub as SC
from billflow.plans.remit import run_remit
from billflow.schema import (PROVIDER_HEADERS, TXN_UPDATED, WORKLIST_HEADERS, YES)
from billflow.session import checkpoint_dir, get_session
from billflow.sources import files as FS
from billflow.sources.rules import rules_long
from billflow.sources.snapshots import compact, with_current
from billflow.sources.splits import read_split_table

STATE = T.StructType([T.StructField("case_id", T.LongType()), T.StructField("seq", T.LongType()),
                      T.StructField("field", T.StringType()), T.StructField("value", T.StringType())])
STATE_FIELDS = ["is_billed", "exceptions", "active_archived", "transaction_number", "submitted",
                "transaction_status"]
STAGES = ["casework", "submit", "annotate"]
# What identifies a case; the other columns only order cases that agree in these.
CASE_KEY = ["client_id", "client_name", "date_time", "staff", "service_type"]


# ---- inputs ---------------------------------------------------------------------------

def is_csv(spark: SparkSession, path: str) -> bool:
    """A CSV file, or a folder that holds CSV files (only the listing is read)."""
    return path.lower().endswith(".csv") or not FS.file_inventory(spark, path, "*.[cC][sS][vV]").isEmpty()


def read_table(spark: SparkSession, path: str, headers: dict[str, str] | None = None, split: bool = False) -> DataFrame:
    """A CSV export (all text, NA tokens -> NULL) or a parquet table, with
    stripped headers renamed to canonical names (``headers``: a table's own).

    ``split``: one large export is read by many tasks; for tables whose row order says
    nothing (attendance, registry, remittance rows)."""
    csv = read_split_table if split else FS.read_text_table
    df = csv(spark, path) if is_csv(spark, path) else spark.read.parquet(path)
    return FS.rename_to_canonical(FS.strip_headers(df), headers)


def with_position(df: DataFrame, col: str = "position") -> DataFrame:
    """Carry the row's place in its file: list order decides 'first match' later.

    A ``position`` column is taken as it is (as a number). Without one, the place in
    the file is used: exact for a list exported as one file, and reproduced when a
    task is retried; several files count in the order in which Spark reads them.
    """
    if col in df.columns:
        return df.withColumn(col, F.col(col).cast("string").try_cast("bigint"))
    return df.withColumn(col, F.monotonically_increasing_id())


def with_case_id(df: DataFrame, col: str = "item_id") -> DataFrame:
    """A case id from the content: a hash of what identifies the case and its
    occurrence among the rows that agree in it.

    Equal rows are counted (combined map-side) and dealt out again, so copies of one
    row, however many, never meet in one task; rows that agree in the identity but
    not in the rest are ordered by their content.
    """
    if col in df.columns:
        return df.withColumn(col, F.col(col).cast("string").try_cast("bigint"))
    cols = df.columns
    whole = lambda cs: [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cs]
    key = [c for c in CASE_KEY if c in cols] or cols
    counted = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_key", F.xxhash64(*whole(key))).withColumn("_all", F.sha2(F.concat_ws("\1", *whole(cols)), 256)))
    before = Window.partitionBy("_key").orderBy("_all").rowsBetween(Window.unboundedPreceding, -1)
    dealt = counted.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (dealt.select(*cols, "_key", "_first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i"))
            .select(F.xxhash64("_key", F.col("_first") + F.col("_i")).alias(col), *cols))


def split_ids(cases: DataFrame) -> DataFrame:
    """An id for every copy of a case: a client listed with several payors makes
    several work-list rows of one attendance row, each billed on its own. The first
    (by payor) keeps the row's id; the groups are a client's payors, so small."""
    n = F.row_number().over(Window.partitionBy("item_id").orderBy("payor_name"))
    return cases.withColumn("_copy", n).withColumn(
        "item_id", F.when(F.col("_copy") == 1, F.col("item_id")).otherwise(F.xxhash64("item_id", "_copy"))).drop("_copy")


def rules_table(spark: SparkSession, path: str) -> DataFrame:
    return rules_long(FS.read_text_table(spark, path)) if is_csv(spark, path) else spark.read.parquet(path)


def outcomes_table(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    number = lambda c: F.col(c).cast("string").try_cast("bigint")
    return df.withColumns({"case_id": number("case_id"), "seq": number("seq"),
                           "ok": F.col("ok").cast("string").try_cast("boolean")})


# ---- state log ------------------------------------------------------------------------

def read_state(spark: SparkSession, path: str) -> DataFrame:
    """All events so far (none before the first day)."""
    return FS.read_if_exists(spark, path, STATE)


def write_events(df: DataFrame, path: str, asof: dt.date, stage: str, fields: list[str],
                 key: str = "item_id") -> None:
    """The non-NULL ``fields`` of ``df`` as the events of one day and stage; a rerun replaces them."""
    seq = asof.toordinal() * 10 + STAGES.index(stage)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    events = (df.select(F.col(key).alias("case_id"), F.lit(seq).cast("bigint").alias("seq"), F.explode(pairs).alias("_e"))
              .select("case_id", "seq", "_e.field", "_e.value").filter("value is not null"))
    events.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_date={asof.strftime('%m%d%Y')}/stage={stage}")


def with_state(df: DataFrame, path: str, fields: list[str], before: int | None = None) -> DataFrame:
    """``df`` with the current value of each field (replacing columns of that name)."""
    return with_current(df, "item_id", path, fields, STATE, before)


def compact_job(spark: SparkSession, state: str, asof: dt.date) -> str | None:
    """Fold the events of the days before ``asof`` into a snapshot of the state log."""
    checkpoint_dir(spark)
    return compact(spark, state, STATE_FIELDS, STATE, before=asof.toordinal() * 10)


# ---- the jobs -------------------------------------------------------------------------

def scrub_job(spark: SparkSession, attendance: str, clients: str, rules: str, out: str,
              asof: dt.date) -> dict[str, int]:
    """Exports -> exception / manual / straightforward lists (one scan, one write)."""
    att = read_table(spark, attendance, split=True)
    if att.isEmpty():  # nothing exported today
        FS.clear_run(spark, out, asof)
        return {"exception": 0, "manual": 0, "straightforward": 0}
    cl = with_position(read_table(spark, clients))
    return SC.run_scrub(with_case_id(att), cl.select("client_id", "payor", "position"),
                        rules_table(spark, rules), asof, out)


def casework_job(spark: SparkSession, a: argparse.Namespace, asof: dt.date) -> int:
    """Straightforward cases that are neither billed nor excepted yet -> worked cases
    (matches, charges, route, exception) and their state events; the number worked.

    What earlier days decided is left alone. A rerun of the day works the day's
    cases again from the same inputs and replaces its output and events, so nothing
    is worked twice. With ``strict`` (the default) a provider master that lists a key
    twice, or a case whose provider is in no master, stops the run before anything is
    written, as the source does; without, the first row in list order counts, and such
    a case gets its exception. With ``by_name`` clients are found by the name search.
    """
    cases = FS.read_run_or_none(spark, a.scrubbed, asof, route="straightforward")
    checkpoint_dir(spark)
    if cases is not None:
        cases = split_ids(cases.drop("route")).withColumn("_exported", F.col("is_billed"))
        cases = GT.pending_cases(with_state(cases, a.state, ["is_billed", "exceptions", "active_archived"],
                                            before=asof.toordinal() * 10))
        cases = (cases.withColumn("is_billed", F.coalesce("is_billed", "_exported"))
                 .drop("_exported", "exceptions").checkpoint())
    if cases is None or cases.isEmpty():  # nothing to work today
        FS.clear_run(spark, a.out, asof)
        write_events(spark.createDataFrame([], "item_id long, is_billed string"), a.state, asof, "casework", ["is_billed"])
        return 0
    provider = lambda p: with_position(read_table(spark, p, PROVIDER_HEADERS))
    x = CW.CaseInputs(
        cases=cases, registry=read_table(spark, a.registry, split=True),
        lines=with_position(read_table(spark, a.lines)),
        coverage=with_position(read_table(spark, a.coverage)),
        invoices=invoices_table(spark, a.invoices),
        outcomes=outcomes_table(spark, a.outcomes), rules=rules_table(spark, a.rules),
        by_payor=provider(a.by_payor), by_staff=provider(a.by_staff), by_staff_private=provider(a.by_staff_private),
        days=M.dos_range(cases), prune=True, by_name=getattr(a, "by_name", False))
    worked = CW.worked_cases(x).checkpoint()
    if getattr(a, "strict", True):
        key = F.when(F.col("provider_source") == "payor", F.col("payor_name")).otherwise(F.col("staff"))
        lost = worked.filter("not provider_found").select(F.concat(F.lit("by_"), "provider_source").alias("master"), key.alias("key"))
        LK.validate_masters({"by_payor": (x.by_payor, "payer"), "by_staff": (x.by_staff, "staff"),
                             "by_staff_private": (x.by_staff_private, "staff")}, lost)
    FS.write_run(worked, a.out, asof)
    done = worked.withColumn("active_archived", F.col("new_active_archived"))
    write_events(done, a.state, asof, "casework", ["is_billed", "exceptions", "active_archived"])
    return worked.count()


def invoices_table(spark: SparkSession, path: str) -> DataFrame:
    df = with_position(read_table(spark, path))
    return df.withColumn("case_id", F.col("case_id").cast("string").try_cast("bigint")) if "case_id" in df.columns else df


def claims_job(spark: SparkSession, casework: str, by_staff_private: str, out: str, asof: dt.date,
               state: str | None = None, strict: bool = True) -> None:
    """Worked cases -> flat claim records (``out/records``) and nested claim forms of
    those not submitted yet (``out/forms``), both in dated folders. With ``strict`` (the
    default) a portal master that lists a staff member twice stops it before it writes."""
    worked = FS.read_run_or_none(spark, casework, asof)
    records, forms = (f"{out.rstrip('/')}/{x}" for x in ("records", "forms"))
    if worked is None:
        FS.clear_run(spark, records, asof)
        FS.clear_run(spark, forms, asof)
        return
    providers = with_position(read_table(spark, by_staff_private, PROVIDER_HEADERS))
    if strict:
        LK.validate_masters({"by_staff_private": (providers, "staff")})
    FS.write_run(CL.claim_record(worked), records, asof)
    rec = FS.read_run(spark, records, asof).drop("run_year", "run_month", "run_date")
    if state:
        rec = GT.pending_claims(with_state(rec, state, ["submitted"])).drop("submitted")
    FS.write_run(CW.claim_forms(rec, providers), forms, asof)


def submit_job(spark: SparkSession, claims: str, outcomes: str, state: str, asof: dt.date) -> int:
    """The portal's answers -> transaction number and Status = Yes of each claim that
    went through, as state events; the number of such claims."""
    rec = FS.read_run_or_none(spark, f"{claims.rstrip('/')}/records", asof)
    if rec is None:
        return 0
    done = (CL.with_outcome(rec, outcomes_table(spark, outcomes)).filter("out_ok")
            .select("item_id", F.col("out_txn").alias("transaction_number"), F.lit(YES).alias("submitted")))
    write_events(done, state, asof, "submit", ["transaction_number", "submitted"])
    return done.count()


def annotate_job(spark: SparkSession, claims: str, invoices: str, state: str, out: str, asof: dt.date) -> int:
    """Invoice notes of the submitted claims whose note is not written yet, and their
    state events; the number of notes."""
    rec = FS.read_run_or_none(spark, f"{claims.rstrip('/')}/records", asof)
    if rec is None:
        FS.clear_run(spark, out, asof)
        return 0
    checkpoint_dir(spark)
    own = asof.toordinal() * 10 + STAGES.index("annotate")
    todo = GT.pending_annotations(with_state(rec, state, ["transaction_number", "submitted", "transaction_status"], before=own),
                                  TXN_UPDATED)
    notes = M.invoice_annotate(todo, invoices_table(spark, invoices)).checkpoint()
    FS.write_run(notes, out, asof)
    write_events(notes, state, asof, "annotate", ["transaction_status"])
    return notes.filter("invoice_note is not null").count()


def remit_job(spark: SparkSession, rows: str, worklist: str, states: str, practices: str, documents: str,
              ledger: str, asof: dt.date, login: str | None = None) -> int:
    """Remittance rows -> the day's new ledger rows (rerun-safe)."""
    inv = FS.file_inventory(spark, documents, "*.pdf")
    wl = with_position(read_table(spark, worklist, WORKLIST_HEADERS))
    names = lambda p: read_table(spark, p, WORKLIST_HEADERS)
    return run_remit(spark, read_table(spark, rows, WORKLIST_HEADERS, split=True), wl, names(states), names(practices), inv,
                     ledger, asof, login)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="billflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    needs = {
        "scrub": ("attendance", "clients", "rules", "out"),
        "casework": ("scrubbed", "registry", "lines", "coverage", "invoices", "outcomes", "rules",
                     "by-payor", "by-staff", "by-staff-private", "state", "out"),
        "claims": ("casework", "by-staff-private", "state", "out"),
        "submit": ("claims", "outcomes", "state"),
        "annotate": ("claims", "invoices", "state", "out"),
        "compact": ("state",),
        "remit": ("rows", "worklist", "states", "practices", "documents", "ledger")}
    for job, options in needs.items():
        sp = sub.add_parser(job)
        for o in options:
            sp.add_argument(f"--{o}", required=True)
        sp.add_argument("--asof", required=True, type=dt.date.fromisoformat)
        if job in ("casework", "claims"):  # masters as they are: first row of a key, exceptions for missing ones
            sp.add_argument("--allow-missing-providers", dest="strict", action="store_false")
        if job == "casework":
            sp.add_argument("--by-name", dest="by_name", action="store_true")
        if job == "remit":
            sp.add_argument("--login")
    a = p.parse_args(argv)
    spark = get_session()
    if a.job == "scrub":
        print(scrub_job(spark, a.attendance, a.clients, a.rules, a.out, a.asof))
    elif a.job == "casework":
        print(casework_job(spark, a, a.asof))
    elif a.job == "claims":
        claims_job(spark, a.casework, a.by_staff_private, a.out, a.asof, a.state, a.strict)
    elif a.job == "submit":
        print(submit_job(spark, a.claims, a.outcomes, a.state, a.asof))
    elif a.job == "annotate":
        print(annotate_job(spark, a.claims, a.invoices, a.state, a.out, a.asof))
    elif a.job == "compact":
        print(compact_job(spark, a.state, a.asof))
    else:
        print(remit_job(spark, a.rows, a.worklist, a.states, a.practices, a.documents, a.ledger, a.asof, a.login))


if __name__ == "__main__":
    main()
