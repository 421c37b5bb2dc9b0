"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billflow.functions import text as TX
from billflow.operators import claims as CL
from billflow.operators import gates as GT
from billflow.operators import lookups as LK
from billflow.operators import matching as M
from billflow.operators import remit as RM
from billflow.operators import state as ST
from billflow.plans import bindings as B
from billflow.plans import casework as CW
from billflow.plans import remit as RP
from billflow.plans import scrub
from billflow.schema import RULE_COLUMNS
from billflow.session import checkpoint_dir
from billflow.sources import files as FS
from billflow.sources.rules import rules_long
from billflow.sources.splits import read_split_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@register("scrub_straightforward")
def q_scrub_straightforward(spark, sf):
    return scrub.scrub_straightforward(B.attendance(spark, sf), B.client_export(spark, sf),
                                       B.rules(spark), B.ASOF)


@register("scrub_manual")
def q_scrub_manual(spark, sf):
    return scrub.scrub_manual(B.attendance(spark, sf), B.client_export(spark, sf), B.rules(spark))


@register("scrub_exception")
def q_scrub_exception(spark, sf):
    return scrub.scrub_exception(B.attendance(spark, sf), B.rules(spark))


# ---- case work (registry, service lines, coverage, providers, claims) ----


def cases(spark, sf):
    """Today's straightforward cases, carrying their prior Active/Archived state."""
    return B.prior_state(q_scrub_straightforward(spark, sf))


def stored(df):
    """``df``, written once below ``spark.checkpoint.dir``: for what is measured and joined more than once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def case_inputs(spark, sf) -> CW.CaseInputs:
    return CW.CaseInputs(
        cases=stored(cases(spark, sf)), registry=B.registry(spark, sf), lines=B.service_lines(spark, sf),
        coverage=B.coverage(spark, sf), invoices=B.invoices(spark, sf),
        outcomes=B.outcomes(spark, sf), rules=B.rules(spark),
        by_payor=B.provider_by_payor(spark, sf), by_staff=B.provider_by_staff(spark, sf),
        by_staff_private=B.provider_by_staff_private(spark, sf), days=lookback_days())


def lookback_days() -> M.DosRange:
    """The service dates that today's straightforward cases are selected by."""
    days = GT.lookback_dates(B.ASOF)
    return min(days), max(days), False


@register("registry_match")
def q_registry_match(spark, sf):
    df = M.registry_match(cases(spark, sf), B.registry(spark, sf))
    return df.select("item_id", "client_id", "reg_found", "reg_tab", "reg_full_name")


@register("registry_candidates")
def q_registry_candidates(spark, sf):
    df = M.registry_search(stored(B.named_cases(cases(spark, sf))), B.named_registry(spark, sf))
    return df.select("item_id", "client_id", "reg_found", "reg_tab", "reg_full_name", "found_by", "n_shown")


@register("archive_flag")
def q_archive_flag(spark, sf):
    df = M.archive_flag(M.registry_match(cases(spark, sf), B.registry(spark, sf)))
    return df.filter("reg_found").select("item_id", "active_archived", "new_active_archived",
                                         "needs_rearchive")


@register("normalise_name")
def q_normalise_name(spark, sf):
    g = B.registry(spark, sf)
    return g.select("client_id", "tab", TX.normalise_name(
        F.col("first_name"), F.col("middle_name"), F.col("last_name")).alias("full_name"))


@register("service_match_semi")
def q_service_match_semi(spark, sf):
    return M.service_match_semi(cases(spark, sf), B.service_lines(spark, sf), lookback_days())


@register("service_match_anti")
def q_service_match_anti(spark, sf):
    return M.service_match_anti(cases(spark, sf), B.service_lines(spark, sf), lookback_days())


@register("extract_codes")
def q_extract_codes(spark, sf):
    return B.service_lines(spark, sf).select(
        "line_id", TX.extract_codes(F.col("dx_text")).alias("dx_codes"))


@register("charge_rule")
def q_charge_rule(spark, sf):
    df = CL.dx_present(M.service_match(cases(spark, sf), B.service_lines(spark, sf), lookback_days()))
    df = CL.charge_rule(df.filter(F.col("svc_found") & F.col("dx_ok")))
    return df.select("item_id", "status", "charge_amount", "client_amount", "insurer_amount",
                     "quantity", CL.money_cents(F.col("charge_amount")).alias("charge_cents"))


def _resolved(spark, sf):
    return M.provider_resolution(cases(spark, sf), B.rules(spark), B.provider_by_payor(spark, sf),
                                 B.provider_by_staff(spark, sf),
                                 B.provider_by_staff_private(spark, sf))


@register("provider_resolution")
def q_provider_resolution(spark, sf):
    return _resolved(spark, sf).select("item_id", "provider_source", "rendering_provider",
                                       "billing_provider", "provider_found")


@register("missing_master")
def q_missing_master(spark, sf):
    return _resolved(spark, sf).filter(~F.col("provider_found")).select(
        "item_id", "provider_source", "staff", "payor_name")


@register("duplicate_keys")
def q_duplicate_keys(spark, sf):
    parts = [(B.client_export(spark, sf), "client_id", "client_export"),
             (B.provider_by_payor(spark, sf), "payer", "provider_by_payor"),
             (B.provider_by_staff(spark, sf), "staff", "provider_by_staff"),
             (B.provider_by_staff_private(spark, sf), "staff", "provider_by_staff_private")]
    out = None
    for dim, key, name in parts:
        d = LK.duplicate_keys(dim, key).select(F.lit(name).alias("master"),
                                               F.col(key).alias("key"), "n_rows")
        out = d if out is None else out.unionByName(d)
    return out


@register("active_coverage")
def q_active_coverage(spark, sf):
    return M.active_coverage(B.coverage(spark, sf), B.rules(spark))


@register("case_routing")
def q_case_routing(spark, sf):
    return CL.case_routing(_resolved(spark, sf)).select("item_id", "payor_name", "status", "route")


@register("exception_tagging")
def q_exception_tagging(spark, sf):
    return CW.worked_cases(case_inputs(spark, sf)).select("item_id", "route", "exceptions",
                                                          "error_detail", "is_billed")


def worked(spark, sf):
    """The case-work stage's output, which the claim stages start from."""
    return CW.worked_cases(case_inputs(spark, sf))


def claim_records(spark, sf):
    return CL.claim_record(worked(spark, sf))


@register("claim_record")
def q_claim_record(spark, sf):
    return claim_records(spark, sf)


@register("claim_assembly")
def q_claim_assembly(spark, sf):
    return CL.flatten_claim(CW.claim_forms(claim_records(spark, sf),
                                           B.provider_by_staff_private(spark, sf)))


@register("diagnosis_explode")
def q_diagnosis_explode(spark, sf):
    return CL.diagnosis_explode(claim_records(spark, sf))


@register("apply_outcome")
def q_apply_outcome(spark, sf):
    df = CL.case_routing(_resolved(spark, sf))
    df = df.filter(F.col("route").isin("await_submission", "claim_file"))
    df = CL.apply_outcome(CL.with_outcome(df, B.outcomes(spark, sf)))
    return df.select("item_id", "route", "is_billed", "exceptions", "error_detail",
                     "transaction_number", "submitted")


def claims_txn(spark, sf):
    return CW.claims_with_transactions(claim_records(spark, sf), B.outcomes(spark, sf))


def annotated(spark, sf):
    """Invoice notes of the claim records, which are made once: their keys are measured before they are joined."""
    return M.invoice_annotate(stored(claims_txn(spark, sf)), B.invoices(spark, sf))


@register("invoice_annotate")
def q_invoice_annotate(spark, sf):
    df = annotated(spark, sf)
    return df.select("item_id", "claim_invoice_number", "transaction_number",
                     "invoice_position", "invoice_note", "transaction_status")


# ---- scalars, gates, sources, remittance, state ----


W_COLS = ["item_id", "client_id", "is_billed", "status", "service_type", "date_time", "staff"]


@register("scan_text")
def q_scan_text(spark, sf):
    path = FS.scratch_path(spark, "attendance-csv")
    FS.write_text_table(B.attendance(spark, sf), path)
    df = FS.read_text_table(spark, path, columns=W_COLS)
    return df.withColumn("item_id", F.col("item_id").cast("bigint"))


@register("scan_text_split")
def q_scan_text_split(spark, sf):
    """O-01: remittance rows, whose text has line breaks, as quoted cells of an export read by splits."""
    path = FS.scratch_path(spark, "remittance-csv")
    FS.write_text_table(B.remit_rows(spark, sf).select("item_id", "practice", "row_text"), path)
    df = read_split_table(spark, path, columns=["item_id", "practice", "row_text"])
    return df.withColumn("item_id", F.col("item_id").cast("bigint"))


@register("dated_run")
def q_dated_run(spark, sf):
    """O-07: a run written to its year/month/day folder and read back by its date."""
    path = FS.scratch_path(spark, "dated-run")
    FS.write_run(B.attendance(spark, sf), path, B.ASOF)
    return FS.read_run(spark, path, B.ASOF)


@register("route_sink")
def q_route_sink(spark, sf):
    """O-08: the three outputs of a run written into sibling folders in one write, and
    a rerun of the day, which replaces them."""
    path = FS.scratch_path(spark, "route-sink")
    routes = scrub.scrub_routes(B.attendance(spark, sf), B.client_export(spark, sf), B.rules(spark), B.ASOF)
    FS.write_routes(routes.limit(5).withColumn("route", F.lit("stale")), path, B.ASOF)
    FS.write_routes(routes, path, B.ASOF)
    return FS.read_run(spark, path, B.ASOF).drop("run_year", "run_month", "run_date")


def ragged_sheet(spark, sf):
    """A rule sheet with ragged columns (NULL padding), built from customer."""
    c = B.table(spark, sf, "customer")
    ck = F.col("c_custkey")
    h = {rule: header for header, rule in RULE_COLUMNS.items()}
    return c.select(
        F.when(ck % 50 == 0, F.element_at(F.array(F.lit("Canceled"), F.lit("Rescheduled"),
                                                   F.lit("Upcoming")), (ck % 3 + 1).cast("int")))
         .alias(h["exclude_status"]),
        F.when(ck % 7 == 0, (ck % 1000 + 0.0)).alias(h["no_show_cpts"]),
        F.when(ck % 11 == 0, (ck % 500 + 90000.0)).alias(h["late_cancel_cpts"]),
        F.when(ck % 13 == 0, F.concat((ck % 300).cast("string"), F.lit(".0"))).alias(h["kept_cpts"]),
        F.when(ck % 17 == 0, F.concat(F.lit("Plan "), (ck % 5).cast("string"))).alias(h["private_payor"]),
        F.when(ck % 19 == 0, ck.cast("string")).alias(h["exception_client"]),
        F.when(ck % 23 == 0, F.concat(F.lit("Payor "), (ck % 4).cast("string"))).alias(h["staff_payor"]),
    )


@register("rules_unpivot")
def q_rules_unpivot(spark, sf):
    return rules_long(ragged_sheet(spark, sf))


@register("strip_headers")
def q_strip_headers(spark, sf):
    c = B.table(spark, sf, "customer")
    raw = c.select(F.col("c_custkey").cast("string").alias("  Client Id "),
                   F.col("c_name").alias("Client Name  "),
                   F.col("c_mktsegment").alias(" Primary Insurance: Provider Name"),
                   F.lit(None).cast("string").alias("   "))
    return FS.rename_to_canonical(FS.strip_headers(raw))


@register("project_rename_drop")
def q_project_rename_drop(spark, sf):
    c = B.client_export(spark, sf)
    return c.select("client_id", "payor", "position").withColumnRenamed("payor", "payor_name") \
        .drop("position")


@register("add_missing_columns")
def q_add_missing_columns(spark, sf):
    return FS.add_missing_columns(B.attendance(spark, sf), ["exceptions", "active_archived", "status"])


@register("null_to_empty")
def q_null_to_empty(spark, sf):
    return FS.null_to_empty(B.attendance(spark, sf))


@register("recode_contains")
def q_recode_contains(spark, sf):
    c = B.client_export(spark, sf)
    return c.select("client_id", "payor", TX.recode_contains(F.col("payor")).alias("payor_recoded"))


@register("code_prefix")
def q_code_prefix(spark, sf):
    w = B.attendance(spark, sf)
    return w.select("item_id", TX.code_prefix(F.col("service_type")).alias("code"))


@register("date_part_text")
def q_date_part_text(spark, sf):
    w = B.attendance(spark, sf)
    d = F.col("date_time")
    return w.select("item_id", TX.date_text(d).alias("date_text"), TX.first10(d).alias("first10"),
                    TX.strip_zone(d).alias("no_zone"),
                    F.date_format(TX.to_service_date(d), "yyyy-MM-dd").alias("service_date"))


@register("split_parts")
def q_split_parts(spark, sf):
    c = B.table(spark, sf, "customer")
    ck = F.col("c_custkey").cast("string")
    provider = F.concat(F.lit("Dr "), F.col("c_name"), F.lit(" , NPI "), ck)
    url = F.concat(F.lit("/clients/details/"), ck)
    name = F.concat(F.lit("  "), F.col("c_name"), F.lit("   Smith"))
    return c.select(ck.alias("client_id"), TX.list_head(provider).alias("provider_head"),
                    TX.path_tail(url).alias("url_id"), TX.first_token(name).alias("first_token"))


@register("date_labels")
def q_date_labels(spark, sf):
    o = B.table(spark, sf, "orders")
    d = F.to_date(F.col("o_orderdate"))
    mmddyyyy = F.date_format(d, "MMddyyyy")
    return o.select(
        F.col("o_orderkey").alias("item_id"), mmddyyyy.alias("mmddyyyy"),
        F.concat_ws("-", F.substring(mmddyyyy, 1, 2), F.substring(mmddyyyy, 3, 2),
                    F.substring(mmddyyyy, 5, 4)).alias("dashed"),
        F.date_format(d, "MM MMM''yyyy").alias("month_label"),
        F.date_format(F.date_sub(d, 1), "MM/dd/yyyy").alias("yesterday"),
        F.date_format(F.trunc(d, "month"), "MM/dd/yyyy").alias("month_start"))


@register("billed_split")
def q_billed_split(spark, sf):
    return GT.tag_billed(B.attendance(spark, sf)).select("item_id", "route")


@register("status_exclusion")
def q_status_exclusion(spark, sf):
    return GT.status_exclusion(B.attendance(spark, sf), B.rules(spark))


@register("client_exclusion")
def q_client_exclusion(spark, sf):
    return GT.client_exclusion(B.attendance(spark, sf), B.rules(spark))


@register("code_gate")
def q_code_gate(spark, sf):
    return GT.code_gate(B.attendance(spark, sf), B.rules(spark))


@register("billed_exception_gate")
def q_billed_exception_gate(spark, sf):
    """The symmetric variant (Kept clause negated like the other two)."""
    return scrub.scrub_exception(B.attendance(spark, sf), B.rules(spark), symmetric=True)


@register("inactive_blank_filter")
def q_inactive_blank_filter(spark, sf):
    df = LK.payor_lookup(B.attendance(spark, sf), B.client_export(spark, sf))
    return GT.drop_blank(GT.drop_inactive_staff(df))


@register("business_day_lookback")
def q_business_day_lookback(spark, sf):
    return GT.business_day_lookback(B.attendance(spark, sf), B.ASOF)


@register("business_day_lookback_weekday")
def q_business_day_lookback_weekday(spark, sf):
    return GT.business_day_lookback(B.attendance(spark, sf), B.ASOF + _dt.timedelta(days=2))


@register("payor_lookup")
def q_payor_lookup(spark, sf):
    return LK.payor_lookup(B.attendance(spark, sf), B.client_export(spark, sf))


@register("payor_lookup_first")
def q_payor_lookup_first(spark, sf):
    return LK.payor_lookup(B.attendance(spark, sf), B.client_export(spark, sf), dup="first")


@register("stage_counts")
def q_stage_counts(spark, sf):
    routes = scrub.scrub_routes(B.attendance(spark, sf), B.client_export(spark, sf),
                                B.rules(spark), B.ASOF)
    return ST.stage_counts(routes)


# remittance

def prior_ledger(spark, sf):
    """Checks seen earlier in the day (every sixth remittance row)."""
    p = RM.parse_remit_row(B.remit_rows(spark, sf)).filter(F.col("item_id") % 6 == 0)
    return p.select("check_no")


def downloaded(spark, sf):
    """Documents that arrived: three of every four expected names."""
    c = RM.with_doc_name(RM.remit_candidates(B.remit_rows(spark, sf), B.ASOF))
    return c.filter(F.col("item_id") % 4 != 0).select(
        F.concat(F.lit("/eob/"), F.col("doc_name")).alias("path"))


@register("parse_remit_row")
def q_parse_remit_row(spark, sf):
    return RM.parse_remit_row(B.remit_rows(spark, sf)).drop("row_text")


@register("sanitise_text")
def q_sanitise_text(spark, sf):
    p = RM.sanitise_names(RM.parse_remit_row(B.remit_rows(spark, sf)))
    return p.select("item_id", "payer", "payee")


@register("remit_date_window")
def q_remit_date_window(spark, sf):
    c = RM.remit_candidates(B.remit_rows(spark, sf), B.ASOF)
    return c.select("item_id", "check_no", "check_date", "received_date")


@register("doc_name")
def q_doc_name(spark, sf):
    c = RM.with_doc_name(RM.remit_candidates(B.remit_rows(spark, sf), B.ASOF))
    return c.select("item_id", "doc_name")


@register("unseen_checks")
def q_unseen_checks(spark, sf):
    c = RM.remit_candidates(B.remit_rows(spark, sf), B.ASOF)
    return RM.unseen_checks(c, prior_ledger(spark, sf)).select("item_id", "check_no")


@register("download_reconcile")
def q_download_reconcile(spark, sf):
    c = RM.with_doc_name(RM.remit_candidates(B.remit_rows(spark, sf), B.ASOF))
    return RM.download_reconcile(c, downloaded(spark, sf)).select("item_id", "doc_name", "status")


def remit_status(spark, sf):
    return RM.worklist_status(RP.todo(B.worklist(spark, sf)), B.known_states(spark, sf),
                              B.known_practices(spark, sf), B.remit_rows(spark, sf), B.ASOF)


@register("parse_rejects")
def q_parse_rejects(spark, sf):
    return RM.parse_rejects(B.remit_rows(spark, sf)).select("item_id", "practice", "row_text")


@register("worklist_status")
def q_worklist_status(spark, sf):
    return remit_status(spark, sf).select("login", "state_name", "practice", "rsm", "wl_status")


@register("remit_ledger")
def q_remit_ledger(spark, sf):
    return RP.ledger_delta(B.remit_rows(spark, sf), remit_status(spark, sf), prior_ledger(spark, sf),
                           downloaded(spark, sf), B.ASOF)


@register("distinct_keys")
def q_distinct_keys(spark, sf):
    return ST.distinct_keys(prior_ledger(spark, sf), "check_no")


# state and file arrivals

@register("state_current")
def q_state_current(spark, sf):
    return ST.state_current(B.state_log(spark, sf), list(B.STATE_FIELDS))


@register("pending_work")
def q_pending_work(spark, sf):
    cur = ST.state_current(B.state_log(spark, sf), list(B.STATE_FIELDS))
    return GT.pending_cases(cur).select("case_id")


@register("seed_or_resume")
def q_seed_or_resume(spark, sf):
    cols = ["is_billed", "exceptions", "active_archived"]
    existing = ST.state_current(B.state_log(spark, sf), cols).withColumnRenamed("case_id", "item_id")
    seed = cases(spark, sf).select("item_id").distinct().withColumns(
        {c: F.lit(None).cast("string") for c in cols})
    return FS.seed_or_resume(existing, seed, ["item_id"])


@register("new_arrivals")
def q_new_arrivals(spark, sf):
    return FS.new_arrivals(B.inventory_now(spark, sf), B.inventory_before(spark, sf), ".csv") \
        .select("path", "length")


@register("latest_arrival")
def q_latest_arrival(spark, sf):
    inv = B.inventory_now(spark, sf).withColumn("folder", FS.folder_of())
    out = FS.latest_arrival(inv, by=["folder"], suffix=".pdf")
    return out.select("folder", "path", "length",
                      F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mtime"))


@register("pending_claims")
def q_pending_claims(spark, sf):
    """Claim records not yet submitted (Status != 'Yes') after the outcomes."""
    rec = claims_txn(spark, sf).withColumn(
        "submitted", F.when(F.col("transaction_number").isNotNull(), F.lit("Yes")))
    return GT.pending_claims(rec).select("item_id", "client_id", "claim_invoice_number")


@register("pending_annotations")
def q_pending_annotations(spark, sf):
    """Claim records whose invoice note is not written yet."""
    ann = annotated(spark, sf).withColumn(
        "submitted", F.when(F.col("transaction_number").isNotNull(), F.lit("Yes")))
    return GT.pending_annotations(ann, "Transaction Number updated").select(
        "item_id", "claim_invoice_number", "transaction_number")
