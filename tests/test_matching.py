"""Case matching, providers, charges, routing, claims."""

from pyspark.sql import functions as F

from billflow.operators import claims as CL
from billflow.operators import matching as M
from billflow.operators.lookups import first_by_position
from billflow.plans import registry as RG
from billflow.sources.rules import rules_from_lists
from tests.conftest import SF_SMALL


def test_service_semi_plus_anti_is_input(spark):
    cases = RG.cases(spark, SF_SMALL)
    lines = RG.B.service_lines(spark, SF_SMALL)
    semi, anti = M.service_match_semi(cases, lines), M.service_match_anti(cases, lines)
    assert semi.count() + anti.count() == cases.count()
    assert semi.unionByName(anti).exceptAll(cases).isEmpty()


def test_registry_prefers_active_tab(spark):
    reg = spark.createDataFrame(
        [("1", "Archived", "a", None, "x"), ("1", "Active", "b", None, "y"), ("2", "Archived", "c", None, "z")],
        "client_id string, tab string, first_name string, middle_name string, last_name string")
    for c in ["dob", "gender", "street", "city", "state", "zip"]:
        reg = reg.withColumn(c, F.lit(None).cast("string"))
    best = {r.client_id: r.tab for r in M.best_registry_entry(reg).collect()}
    assert best == {"1": "Active", "2": "Archived"}


def test_provider_precedence_has_no_fall_through(spark):
    rules = rules_from_lists(spark, {"private_payor": ["Plan B"], "staff_payor": ["Plan Z"]})
    cases = spark.createDataFrame([(1, "Plan B", "S1"), (2, "Plan Z", "S1"), (3, "Optum", "S1"),
                                   (4, "Plan Z", "S9")], "item_id long, payor_name string, staff string")
    by_payor = spark.createDataFrame([("Optum", "RP", "BP", 0)],
                                     "payer string, rendering_provider string, billing_provider string, position int")
    by_staff = spark.createDataFrame([("S1", "RS", "BS", 0)],
                                     "staff string, rendering_provider string, billing_provider string, position int")
    by_priv = spark.createDataFrame([("S1", "RV", "BV", 0)],
                                    "staff string, rendering_provider string, billing_provider string, position int")
    out = {r.item_id: (r.provider_source, r.rendering_provider, r.provider_found) for r in
           M.provider_resolution(cases, rules, by_payor, by_staff, by_priv).collect()}
    assert out == {1: ("staff_private", "RV", True), 2: ("staff", "RS", True),
                   3: ("payor", "RP", True), 4: ("staff", None, False)}


def test_charge_rule_and_routing(spark):
    df = spark.createDataFrame([(1, "No Show", "120.00", "2", True), (2, "Kept", "120.00", "2", False)],
                               "item_id long, status string, ln_amount string, ln_units string, is_private boolean")
    out = {r.item_id: r for r in CL.case_routing(CL.charge_rule(df)).collect()}
    assert (out[1].charge_amount, out[1].client_amount, out[1].insurer_amount, out[1].quantity) == \
        ("65.00", "65.00", "0.00", "2")
    assert (out[2].charge_amount, out[2].client_amount, out[2].insurer_amount, out[2].quantity) == \
        ("120.00", "0.00", None, "1")
    assert out[1].route == "claim_file" and out[2].route == "await_submission"


def test_first_by_position_is_partial_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("position"),
                                  F.col("id").cast("string").alias("v"))
    out = first_by_position(df, ["k"], ["position"], ["v"])
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, "0"), (1, "1"), (2, "2")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2  # partial (map-side) + final


def test_diagnosis_pointers(spark):
    recs = spark.createDataFrame([(1, "A1,B2,C3")], "item_id long, dx_code string")
    rows = [(r.slot, r.code, r.pointer) for r in CL.diagnosis_explode(recs).orderBy("slot").collect()]
    assert rows == [(0, "A1", 1), (1, "B2", 2), (2, "C3", 3)]


def test_strict_missing_master(spark):
    import pytest
    from billflow.operators.lookups import assert_no_missing, missing_master
    facts = spark.createDataFrame([("S1",), ("S2",), (None,)], "staff string")
    dim = spark.createDataFrame([("S1",)], "staff string")
    assert sorted(str(r.staff) for r in missing_master(facts, "staff", dim, "staff").collect()) == ["None", "S2"]
    with pytest.raises(ValueError):
        assert_no_missing(facts, "staff", dim, "staff")
    assert_no_missing(facts.filter("staff = 'S1'"), "staff", dim, "staff")


def test_line_history_pruning_is_exact(spark):
    cases = RG.cases(spark, SF_SMALL)
    lines = RG.B.service_lines(spark, SF_SMALL)
    full = M.service_match(cases, lines).select("item_id", "payor_name", "ln_line_id")
    pruned = M.service_match(cases, lines, RG.lookback_days()).select("item_id", "payor_name", "ln_line_id")
    assert full.exceptAll(pruned).isEmpty() and pruned.exceptAll(full).isEmpty()


def test_claim_record_has_the_twenty_columns(spark):
    from billflow.schema import CLAIM_RECORD_COLS
    rec = RG.q_claim_record(spark, SF_SMALL)
    assert rec.columns == ["item_id", *CLAIM_RECORD_COLS] and len(CLAIM_RECORD_COLS) == 20


REG = ("client_id string, first_name string, middle_name string, last_name string, dob string, gender string, street string, "
       "city string, state string, zip string, tab string")


def searched(spark, cases, entries):
    reg = spark.createDataFrame([(i, f, m, last, "d", "g", "s", "c", "st", z, tab) for i, f, m, last, z, tab in entries], REG)
    df = spark.createDataFrame(cases, "item_id long, client_id string, client_name string")
    return {r.item_id: (r.reg_found, r.reg_tab, r.reg_zip, r.found_by, r.n_shown) for r in M.registry_search(df, reg).collect()}


def test_name_search_before_the_id(spark):
    """The search order is Active full, Active first token, Archived full, Archived first token; the id accepts."""
    entries = [("1", "Ann", None, "Lee", "a", "Active"), ("1", "Ann", None, "Lee", "b", "Archived"),
               ("2", "Ann", "B.", "Ray", "c", "Archived"), ("2", " ann ", None, "Fox", "d", "Active"),
               ("3", "Zoe", None, "Lee", "e", "Active"), ("4", None, None, None, "f", "Active"), ("5", "Ann", None, "Lee", "g", "Other"),
               ("6", "Mary", "Ann", "Ann", "h", "Archived"), (None, "Ann", None, "Lee", "i", "Active")]
    cases = [(1, "1", "ANN   Lee"), (2, "2", "Ann B. Ray"), (3, "3", "Sam Lee"), (4, "4", ""), (5, "5", "Ann Lee"),
             (6, "6", "ann Before"), (7, None, "Ann Lee"), (8, "1", None), (9, "9", "Ann Lee"), (10, "2", "Fox Unknown")]
    got = searched(spark, cases, entries)
    assert got[1] == (True, "Active", "a", "full name", 2)
    assert got[2] == (True, "Active", "d", "first token", 3)  # its Archived full name would come later
    assert got[6] == (True, "Archived", "h", "first token", 3)
    assert got[10] == (True, "Active", "d", "first token", 1)
    assert all(got[i] == (False, None, None, None, 0) for i in (3, 4, 5, 7, 8, 9))


def test_a_common_name_makes_no_pairs(spark):
    """All clients and all entries share a first token; the join still has one row per case."""
    entries = [(str(i), "Pat", None, f"L{i}", "z", "Active") for i in range(300)]
    got = searched(spark, [(i, str(i), "Pat Q") for i in range(0, 600, 2)], entries)
    assert sum(v[0] for v in got.values()) == 150 and {v[4] for v in got.values()} == {0, 300}
    assert len(got) == 300
