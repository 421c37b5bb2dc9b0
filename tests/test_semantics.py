
from pyspark.sql import functions as F

from billflow.functions import text as TX
from billflow.functions.nulls import ne_keep_null, not_in_keep_null
from billflow.operators import gates as G
from billflow.operators.lookups import payor_lookup, duplicate_keys
from billflow.schema import HOSTILE_CHARS
from billflow.sources.rules import rules_from_lists, rules_long

ATT = "item_id long, client_id string, is_billed string, status string, service_type string, " \
      "date_time string, staff string"


def att(spark, rows):
    return spark.createDataFrame(rows, ATT)


def ids(df):
    return sorted(r.item_id for r in df.select("item_id").collect())


def test_n1_ne_keeps_null(spark):
    df = att(spark, [(1, "a", "Yes", None, None, None, None), (2, "a", None, None, None, None, None),
                     (3, "a", "No", None, None, None, None)])
    assert ids(df.filter(ne_keep_null(F.col("is_billed"), "Yes"))) == [2, 3]
    assert ids(G.open_rows(df)) == [2, 3] and ids(G.billed_rows(df)) == [1]


def test_n2_n3_not_in_keeps_null_and_ignores_null_list_values(spark):
    df = att(spark, [(1, "a", None, "Canceled", None, None, None), (2, "a", None, None, None, None, None),
                     (3, "a", None, "Kept", None, None, None)])
    rules = rules_from_lists(spark, {"exclude_status": ["Canceled", None]})
    assert ids(G.status_exclusion(df, rules)) == [2, 3]
    assert ids(df.filter(not_in_keep_null(F.col("status"), ["Canceled", None]))) == [2, 3]


def test_n4_gate_with_null_service(spark):
    rules = rules_from_lists(spark, {"no_show_cpts": ["993"]})
    df = att(spark, [(1, "a", None, "No Show", None, None, None),
                     (2, "a", None, "Kept", None, None, None),
                     (3, "a", None, "No Show", "993: x", None, None),
                     (4, "a", None, "No Show", "9931: x", None, None),
                     (5, "a", None, None, None, None, None)])
    # No Show with NULL service fails; Kept has an empty list -> needs non-null service.
    assert ids(G.code_gate(df, rules)) == [3, 5]


def test_n5_null_key_matches_null_and_fans_out(spark):
    df = att(spark, [(1, None, None, None, None, None, None), (2, "7", None, None, None, None, None)])
    clients = spark.createDataFrame([(None, "P0", 0), ("7", "P1", 0), ("7", "P2", 1)],
                                    "client_id string, payor string, position int")
    out = payor_lookup(df, clients).select("item_id", "payor_name").collect()
    assert sorted((r.item_id, r.payor_name) for r in out) == [(1, "P0"), (2, "P1"), (2, "P2")]
    first = payor_lookup(df, clients, dup="first").select("item_id", "payor_name").collect()
    assert sorted((r.item_id, r.payor_name) for r in first) == [(1, "P0"), (2, "P1")]


def test_n6_n9_inactive_filter(spark):
    df = att(spark, [(1, None, None, None, None, None, "A (Inactive)"), (2, None, None, None, None, None, None),
                     (3, None, None, None, None, None, "B Inactive"), (4, None, None, None, None, None, "C")])
    assert ids(G.drop_inactive_staff(df)) == [2, 4]


def test_n7_null_dates_dropped(spark):
    import datetime as dt
    df = att(spark, [(1, None, None, None, None, None, None),
                     (2, None, None, None, None, "11/28/2026, 10:00 AM ET", None)])
    assert ids(G.business_day_lookback(df, dt.date(2026, 11, 30))) == [2]


def test_n8_empty_code_list_matches_any_non_null(spark):
    rules = rules_from_lists(spark, {"late_cancel_cpts": []})
    df = att(spark, [(1, None, None, "Late Cancel", "anything", None, None),
                     (2, None, None, "Late Cancel", None, None, None)])
    assert ids(G.code_gate(df, rules)) == [1]


def test_n10_sanitise_parity_with_regex(spark):
    samples = ["a:b?c/d|e'f*g<h>i", 'keep\\back"quote', "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.o for r in df.select(TX.sanitise(F.col("s")).alias("o")).collect()]
    assert got == ["".join(ch for ch in s if ch not in HOSTILE_CHARS) for s in samples]


def test_n11_duplicate_master_keys(spark):
    dim = spark.createDataFrame([("S1", 1), ("S1", 2), ("S2", 3)], "staff string, position int")
    assert [(r.staff, r.n_rows) for r in duplicate_keys(dim, "staff").collect()] == [("S1", 2)]


def test_n12_note_only_with_value(spark):
    df = spark.createDataFrame([("T1",), (None,)], "t string")
    got = [r.n for r in df.select(TX.note_text("ID#", F.col("t")).alias("n")).collect()]
    assert got == ["ID#T1", None]


def test_n13_codes_normalised_to_integer_text(spark):
    sheet = spark.createDataFrame([(993.0, "Canceled"), (None, None), (90837.0, "Upcoming")],
                                  "`No Show CPT's` double, Status string")
    out = sorted((r.rule_name, r.value) for r in rules_long(sheet).collect())
    assert out == [("exclude_status", "Canceled"), ("exclude_status", "Upcoming"),
                   ("no_show_cpts", "90837"), ("no_show_cpts", "993")]


def test_extract_codes_and_name(spark):
    df = spark.createDataFrame([("Dx (F41.1) and (F32.0)", " a ", None, "b  c")],
                               "t string, f string, m string, l string")
    r = df.select(TX.extract_codes(F.col("t")).alias("c"),
                  TX.normalise_name(F.col("f"), F.col("m"), F.col("l")).alias("n")).first()
    assert r.c == "F411,F320" and r.n == "a b c"


def test_python_whitespace_semantics(spark):
    raw = "\t Dr Who , NPI 1"
    df = spark.createDataFrame([(raw, "\n a \tb ", "11/28/2026, 10:00 AM ET ")], "p string, n string, d string")
    r = df.select(TX.list_head(F.col("p")).alias("h"), TX.first_token(F.col("n")).alias("t"),
                  TX.normalise_name(F.col("n")).alias("nn"), TX.strip_zone(F.col("d")).alias("z")).first()
    assert r.h == raw.split(",")[0].strip()
    assert r.t == "\n a \tb ".split()[0]
    assert r.nn == " ".join("\n a \tb ".split())
    assert r.z == "11/28/2026, 10:00 AM ET ".replace(" ET", "").strip()


def test_unicode_whitespace_parity(spark):
    vals = ["\xa0x\x1cy　", "  a b \x85"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(TX.strip_ws(F.col("v")).alias("s"), TX.first_token(F.col("v")).alias("t"),
                     TX.normalise_name(F.col("v")).alias("n")).collect()
    for v, r in zip(vals, rows):
        assert (r.s, r.t, r.n) == (v.strip(), v.split()[0], " ".join(v.split()))
