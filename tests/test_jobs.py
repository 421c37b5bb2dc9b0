"""End-to-end daily jobs on CSV exports with human headers, written from the smoke bindings."""

import argparse
import os
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from billflow import jobs as J
from billflow.operators.lookups import BadMasters, validate_masters
from billflow.plans import bindings as B
from billflow.plans import registry as RG
from billflow.plans.remit import read_ledger, read_rejects, read_worked
from billflow.schema import EXPORT_HEADERS, PROVIDER_HEADERS, RULE_COLUMNS, WORKLIST_HEADERS
from billflow.sources import files as FS
from tests.conftest import SF_SMALL

DAY1, DAY2 = B.ASOF, B.ASOF + J.dt.timedelta(days=1)
ATT = {"client_id": "Client ID Number", "date_time": "Date/Time", "staff": "Staff Member(s)",
       "status": "Status", "service_type": "Service Type", "is_billed": "Is Billed"}


def csv(df, path, headers=None):
    back = {}
    for h, c in (headers or {}).items():
        back.setdefault(c, h)
    df.toPandas().rename(columns=back).to_csv(path, index=False)


@pytest.fixture()
def inputs(spark, scratch):
    """Every table of the work-queue as a CSV export."""
    p = {k: f"{scratch}/{k}.csv" for k in ("attendance", "clients", "rules", "registry", "lines", "coverage", "invoices",
                                           "outcomes", "by_payor", "by_staff", "by_staff_private", "rows", "worklist",
                                           "states", "practices")}
    csv(B.attendance(spark, SF_SMALL).drop("item_id"), p["attendance"], {h: c for c, h in ATT.items()})
    csv(B.client_export(spark, SF_SMALL).orderBy("client_id", "position").select(
        F.col("client_id").alias("Client Id"), F.col("payor").alias("Primary Insurance: Provider Name"), "position"),
        p["clients"])
    by_rule = {r: h for h, r in RULE_COLUMNS.items()}
    width = max(len(v) for v in B.RULES.values())
    pd.DataFrame({by_rule[k]: v + [None] * (width - len(v)) for k, v in B.RULES.items()}).to_csv(p["rules"], index=False)
    people = {h: c for h, c in EXPORT_HEADERS.items() if c not in ("client_id", "status", "service_type", "payor")}
    csv(B.registry(spark, SF_SMALL), p["registry"], people)
    csv(B.service_lines(spark, SF_SMALL), p["lines"])
    csv(B.coverage(spark, SF_SMALL), p["coverage"])
    # the portal's listing has the service date-time, not the case id
    csv(B.invoices(spark, SF_SMALL).join(B.service_lines(spark, SF_SMALL).select(F.col("line_id").alias("case_id"), "dos_text"),
                                         "case_id").drop("case_id"), p["invoices"])
    csv(B.provider_by_payor(spark, SF_SMALL), p["by_payor"], PROVIDER_HEADERS)
    csv(B.provider_by_staff(spark, SF_SMALL), p["by_staff"], PROVIDER_HEADERS)
    csv(B.provider_by_staff_private(spark, SF_SMALL), p["by_staff_private"], PROVIDER_HEADERS)
    pd.DataFrame({"case_id": [], "seq": [], "ok": [], "transaction_no": [], "error_text": []}).to_csv(p["outcomes"], index=False)
    csv(B.remit_rows(spark, SF_SMALL).drop("item_id"), p["rows"], WORKLIST_HEADERS)
    csv(B.worklist(spark, SF_SMALL), p["worklist"], WORKLIST_HEADERS)
    csv(B.known_states(spark, SF_SMALL), p["states"], WORKLIST_HEADERS)
    csv(B.known_practices(spark, SF_SMALL), p["practices"], WORKLIST_HEADERS)
    return p


def case_args(p, scratch, strict=False):
    names = ("registry", "lines", "coverage", "invoices", "outcomes", "rules", "by_payor", "by_staff", "by_staff_private")
    return argparse.Namespace(scrubbed=f"{scratch}/scrub", state=f"{scratch}/state", out=f"{scratch}/cases", strict=strict,
                              **{k: p[k] for k in names})


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_scrub_reads_exports(spark, scratch, inputs):
    counts = J.scrub_job(spark, inputs["attendance"], inputs["clients"], inputs["rules"], f"{scratch}/scrub", DAY1)
    J.main(["scrub", "--attendance", inputs["attendance"], "--clients", inputs["clients"], "--rules", inputs["rules"],
            "--out", f"{scratch}/cli", "--asof", DAY1.isoformat()])
    want = RG.q_scrub_straightforward(spark, SF_SMALL).drop("item_id")
    assert counts["straightforward"] == want.count() == 90
    for out in ("scrub", "cli"):
        got = FS.read_run(spark, f"{scratch}/{out}", DAY1, "straightforward")
        assert rows_of(got.select(want.columns)) == rows_of(want)


def test_case_ids_do_not_depend_on_the_files(spark, scratch, inputs):
    att = J.read_table(spark, inputs["attendance"])
    att = att.unionByName(att.limit(40)).unionByName(att.limit(40))  # copies get ids of their own
    one = J.with_case_id(att.coalesce(1))
    att.orderBy(F.rand(3)).repartition(7).write.option("header", True).csv(f"{scratch}/split")
    two = J.with_case_id(J.read_table(spark, f"{scratch}/split"))
    assert rows_of(one) == rows_of(two)
    assert one.select("item_id").distinct().count() == att.count()


def test_two_days(spark, scratch, inputs):
    J.scrub_job(spark, inputs["attendance"], inputs["clients"], inputs["rules"], f"{scratch}/scrub", DAY1)
    a = case_args(inputs, scratch)
    with pytest.raises(ValueError, match="provider"):
        J.casework_job(spark, case_args(inputs, scratch, strict=True), DAY1)
    assert not os.path.exists(f"{scratch}/cases") and not os.path.exists(f"{scratch}/state")
    n = J.casework_job(spark, a, DAY1)
    worked = FS.read_run(spark, f"{scratch}/cases", DAY1)
    assert n == worked.count() == 90
    left = worked.filter("is_billed is distinct from 'Yes' and exceptions is null").count()
    lost = worked.filter("not provider_found")
    assert lost.count() > 0 and lost.filter("is_billed = 'Yes' or exceptions is null").isEmpty()

    J.claims_job(spark, a.out, inputs["by_staff_private"], f"{scratch}/claims", DAY1, a.state, strict=False)
    records = FS.read_run(spark, f"{scratch}/claims/records", DAY1)
    forms = FS.read_run(spark, f"{scratch}/claims/forms", DAY1)
    assert records.count() == forms.count() > 0
    assert forms.filter("claim.providers.rendering is null or claim.providers.billing is null").isEmpty()
    shared = records.groupBy("claim_invoice_number").count().filter("count > 1 and claim_invoice_number is not null")
    assert shared.isEmpty()

    # the portal takes half of the claims
    ids = sorted(r.item_id for r in records.collect())
    ok = ids[::2]
    pd.DataFrame([(i, 1, i in ok, f"TXN{i}" if i in ok else None, None if i in ok else "no") for i in ids],
                 columns=["case_id", "seq", "ok", "transaction_no", "error_text"]).to_csv(inputs["outcomes"], index=False)
    for _ in range(2):  # a rerun records the same
        assert J.submit_job(spark, f"{scratch}/claims", inputs["outcomes"], a.state, DAY1) == len(ok)
    noted = [J.annotate_job(spark, f"{scratch}/claims", inputs["invoices"], a.state, f"{scratch}/notes", DAY1) for _ in range(2)]
    assert noted[0] == noted[1] > 0
    J.claims_job(spark, a.out, inputs["by_staff_private"], f"{scratch}/claims", DAY1, a.state, strict=False)
    assert FS.read_run(spark, f"{scratch}/claims/forms", DAY1).count() == len(ids) - len(ok)

    # a rerun of the day works the same cases to the same end
    before = rows_of(J.read_state(spark, a.state).filter("stage = 'casework'"))
    assert J.casework_job(spark, a, DAY1) == 90
    after = rows_of(J.read_state(spark, a.state).filter("stage = 'casework'"))
    assert after == before, (set(after) ^ set(before))

    # the next day's export still holds the day's cases: what is done is left alone, by the snapshot too
    assert J.compact_job(spark, a.state, DAY2) and J.compact_job(spark, a.state, DAY2) is None
    today = FS.read_run(spark, f"{scratch}/scrub", DAY1).drop("run_year", "run_month", "run_date")
    FS.write_routes(today, f"{scratch}/scrub", DAY2)
    assert J.casework_job(spark, a, DAY2) == left < 90
    if left == 0:
        assert FS.read_run_or_none(spark, a.out, DAY2) is None
    assert J.annotate_job(spark, f"{scratch}/claims", inputs["invoices"], a.state, f"{scratch}/notes", DAY2) == 0


def test_remit(spark, scratch, inputs):
    docs = os.path.join(scratch, "docs")
    os.makedirs(docs)
    for r in RG.downloaded(spark, SF_SMALL).collect():
        with open(os.path.join(docs, r.path.rsplit("/", 1)[-1]), "w") as f:
            f.write("%PDF")
    args = [*(inputs[k] for k in ("rows", "worklist", "states", "practices")), docs, f"{scratch}/ledger", DAY1]
    one = J.remit_job(spark, *args, login="login0")
    two = J.remit_job(spark, *args)  # the other login's rows
    assert one > 0 and two > 0 and J.remit_job(spark, *args) == 0
    ledger = read_ledger(spark, f"{scratch}/ledger", DAY1)
    assert ledger.count() == one + two
    assert ledger.filter(F.col("status") == "File Downloaded").count() > 0
    assert read_rejects(spark, f"{scratch}/ledger", DAY1).count() > 0
    status = read_worked(spark, f"{scratch}/ledger", DAY1)
    assert status.count() == B.worklist(spark, SF_SMALL).count()


def test_empty_days(spark, scratch, inputs):
    pd.DataFrame({"Client ID Number": pd.Series([], dtype=str)}).to_csv(f"{scratch}/att.csv", index=False)
    a = case_args(inputs, scratch)
    J.scrub_job(spark, inputs["attendance"], inputs["clients"], inputs["rules"], f"{scratch}/scrub", DAY1)
    assert J.casework_job(spark, a, DAY1) == 90
    J.claims_job(spark, a.out, inputs["by_staff_private"], f"{scratch}/claims", DAY1, strict=False)
    # the day is run again, and now nothing was exported: nothing of the first run may stand
    assert J.scrub_job(spark, f"{scratch}/att.csv", "unused", "unused", f"{scratch}/scrub", DAY1) == \
        {"exception": 0, "manual": 0, "straightforward": 0}
    assert J.casework_job(spark, a, DAY1) == 0
    J.claims_job(spark, a.out, inputs["by_staff_private"], f"{scratch}/claims", DAY1, strict=False)
    assert J.submit_job(spark, f"{scratch}/claims", inputs["outcomes"], a.state, DAY1) == 0
    for out in ("scrub", "cases", "claims/records", "claims/forms"):
        assert FS.read_run_or_none(spark, f"{scratch}/{out}", DAY1) is None
    assert J.read_state(spark, a.state).isEmpty()


@pytest.mark.parametrize("table,column", [("by_payor", "Payer"), ("by_staff", "Staff Members"), ("by_staff_private", "Staff Members")])
def test_a_master_that_lists_a_key_twice_stops_the_run(spark, scratch, inputs, table, column):
    J.scrub_job(spark, inputs["attendance"], inputs["clients"], inputs["rules"], f"{scratch}/scrub", DAY1)
    for name in ("by_payor", "by_staff", "by_staff_private"):
        master = pd.read_csv(inputs[name], dtype=str)
        key = master.columns[0] if column not in master.columns and name != table else (column if column in master.columns else master.columns[0])
        master = master.drop_duplicates(key)
        if name == table:
            master = pd.concat([master, master.iloc[[0]]])
        master.to_csv(inputs[name], index=False)
    again = pd.read_csv(inputs[table], dtype=str).iloc[-1][column]
    with pytest.raises(BadMasters, match=f"{table}: '{re.escape(again)}' twice"):
        J.casework_job(spark, case_args(inputs, scratch, strict=True), DAY1)
    assert not os.path.exists(f"{scratch}/cases") and not os.path.exists(f"{scratch}/state")


def test_sound_masters_pass(spark):
    one = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    validate_masters({"x": (one, "k"), "y": (one, "k")})
    lost = spark.createDataFrame([("x", "c"), ("x", "c"), ("x", None)], "master string, key string")
    with pytest.raises(BadMasters, match="x: None missing; x: 'c' missing"):
        validate_masters({"x": (one, "k")}, lost)


def test_the_name_search_decides_in_the_job(spark, scratch, inputs):
    J.scrub_job(spark, inputs["attendance"], inputs["clients"], inputs["rules"], f"{scratch}/scrub", DAY1)
    day = FS.read_run(spark, f"{scratch}/scrub", DAY1).drop("run_year", "run_month", "run_date")
    FS.write_routes(day.withColumn("client_name", F.lit("Nobody Known")).checkpoint(), f"{scratch}/scrub", DAY1)
    a = case_args(inputs, scratch)
    J.casework_job(spark, a, DAY1)
    assert not FS.read_run(spark, a.out, DAY1).filter("reg_found").isEmpty()
    a.by_name = True
    J.casework_job(spark, a, DAY1)
    assert FS.read_run(spark, a.out, DAY1).filter("reg_found").isEmpty()
