"""Gates and the scrub pipeline: properties and the source's asymmetries."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from billflow.operators import gates as G
from billflow.plans import bindings as B
from billflow.plans import scrub
from billflow.sources.rules import rules_from_lists
from tests.conftest import SF_SMALL
from tests.test_semantics import att, ids


def test_billed_split_is_a_partition(spark):
    w = B.attendance(spark, SF_SMALL)
    tagged = G.tag_billed(w)
    assert tagged.count() == w.count()
    billed, opened = G.billed_rows(w), G.open_rows(w)
    assert billed.count() + opened.count() == w.count()
    assert billed.join(opened, "item_id").isEmpty()


def test_exception_gate_asymmetry(spark):
    rules = rules_from_lists(spark, {"kept_cpts": ["90837"], "no_show_cpts": ["993"]})
    df = att(spark, [(1, None, "Yes", "Kept", "90837: a", None, None),
                     (2, None, "Yes", "Kept", "111: a", None, None),
                     (3, None, "Yes", "No Show", "993: a", None, None),
                     (4, None, "Yes", "No Show", "111: a", None, None)])
    assert ids(G.billed_exception_gate(df, rules)) == [1, 4]
    assert ids(G.billed_exception_gate(df, rules, symmetric=True)) == [2, 4]


@settings(max_examples=25, deadline=None)
@given(st.dates(min_value=dt.date(2020, 1, 6), max_value=dt.date(2030, 1, 1)), st.integers(2, 6))
def test_lookback_weekday_schedule_covers_each_day_once(start, weeks):
    # Runs on every Monday..Friday of `weeks` weeks select each interior day exactly once.
    monday = start - dt.timedelta(days=start.weekday())
    runs = [monday + dt.timedelta(days=7 * w + d) for w in range(weeks) for d in range(5)]
    hits = {}
    for r in runs:
        for day in G.lookback_dates(r):
            hits[day] = hits.get(day, 0) + 1
    interior = [monday + dt.timedelta(days=i) for i in range(-4, 7 * (weeks - 1) + 3)]
    assert all(hits.get(d) == 1 for d in interior)


def test_scrub_counts_on_smoke_data(spark):
    w, c, r = B.attendance(spark, SF_SMALL), B.client_export(spark, SF_SMALL), B.rules(spark)
    assert scrub.scrub_straightforward(w, c, r, B.ASOF).count() == 90
    routes = scrub.scrub_routes(w, c, r, B.ASOF)
    counts = {x.route: x.n for x in routes.groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert counts["straightforward"] == 90
    assert counts["manual"] >= counts["straightforward"]


def test_run_scrub_writes_three_outputs_in_one_pass(spark, scratch):
    from billflow.sources.files import read_run
    w, c, r = B.attendance(spark, SF_SMALL), B.client_export(spark, SF_SMALL), B.rules(spark)
    counts = scrub.run_scrub(w, c, r, B.ASOF, scratch)
    assert counts["straightforward"] == 90
    assert counts["manual"] == scrub.scrub_manual(w, c, r).count()
    assert counts["exception"] == scrub.scrub_exception(w, r).count()
    back = read_run(spark, scratch, B.ASOF, route="straightforward")
    assert back.count() == 90
    p = scrub.scrub_routes(w, c, r, B.ASOF)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" in p and p.count("FileScan parquet") == 2  # orders once, customer once


def test_resume_predicates(spark):
    df = spark.createDataFrame(
        [(1, "Yes", None, "Yes", "Transaction Number updated", "", "l1"),
         (2, None, None, None, None, None, "l1"),
         (3, "No", "err", "Yes", None, "Processed", "l2")],
        "item_id long, is_billed string, exceptions string, submitted string, "
        "transaction_status string, wl_status string, login string")
    assert ids(G.pending_cases(df)) == [2]
    assert ids(G.pending_claims(df)) == [2]
    assert ids(G.pending_annotations(df, "Transaction Number updated")) == [2, 3]
    assert ids(G.pending_worklist(df)) == [1, 2]
    assert ids(G.pending_worklist(df, "l1")) == [1, 2]
    assert ids(G.pending_worklist(df, "l2")) == []


def test_lookup_with_unique_keys_keeps_row_count(spark):
    from billflow.operators.lookups import payor_lookup
    w, c = B.attendance(spark, SF_SMALL), B.client_export(spark, SF_SMALL)
    assert payor_lookup(w, c, dup="first").count() == w.count()
    unique = c.filter(F.col("position") == 0)
    assert payor_lookup(w, unique).count() == w.count()
    assert payor_lookup(w, c).count() > w.count()  # duplicates fan out (source merge)
