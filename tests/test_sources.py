"""Landing-zone sources and sinks."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from billflow.operators.state import state_current
from billflow.session import checkpoint_dir
from billflow.sources import files as FS
from billflow.sources.rules import rules_long


def test_text_scan_na_tokens(spark, scratch):
    path = os.path.join(scratch, "a.csv")
    with open(path, "w") as f:
        f.write("x,y\nNA,1\nn/a,\nok,None\n")
    rows = FS.read_text_table(spark, path, columns=["x", "y"]).collect()
    assert [(r.x, r.y) for r in rows] == [(None, "1"), (None, None), ("ok", None)]


def test_header_shaping(spark):
    df = spark.createDataFrame([("1", "n", "z")], "` Client Id ` string, `Client Name  ` string, `  ` string")
    out = FS.rename_to_canonical(FS.strip_headers(df))
    assert out.columns == ["client_id", "client_name"]
    out2 = FS.add_missing_columns(out, ["client_id", "exceptions"])
    assert out2.columns == ["client_id", "client_name", "exceptions"]
    filled = FS.null_to_empty(out2).first()
    assert filled.exceptions == ""


def test_inventory_new_and_latest(spark, scratch):
    for i, name in enumerate(["a.csv", "b.csv", "c.pdf"]):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("x" * (i + 1))
        t = time.time() - 100 + i
        os.utime(os.path.join(scratch, name), (t, t))
    before = FS.file_inventory(spark, scratch).filter(F.col("path").endswith("a.csv"))
    now = FS.file_inventory(spark, scratch)
    fresh = [r.path.rsplit("/", 1)[-1] for r in FS.new_arrivals(now, before, ".csv").collect()]
    assert fresh == ["b.csv"]
    latest = FS.latest_arrival(now).first()
    assert latest.path.endswith("c.pdf") and latest.length == 3
    assert FS.latest_arrival(now, suffix=".csv").first().path.endswith("b.csv")


def test_dated_layout_roundtrip_and_rerun(spark, scratch):
    d1, d2 = dt.date(2026, 11, 30), dt.date(2026, 12, 1)
    df = spark.createDataFrame([(1, "manual"), (2, "straightforward")], "item_id long, route string")
    FS.write_routes(df, scratch, d1)
    FS.write_routes(df.filter("item_id = 1"), scratch, d2)
    FS.write_routes(df.filter("item_id = 2"), scratch, d1)  # rerun of d1, one route only
    got = sorted((r.run_date, r.route, r.item_id) for r in FS.read_runs(spark, scratch).collect())
    assert got == [("11302026", "straightforward", 2), ("12012026", "manual", 1)]
    assert FS.read_run(spark, scratch, d2).count() == 1


def test_seed_or_resume(spark):
    existing = spark.createDataFrame([(1, "Yes")], "item_id long, state string")
    seed = spark.createDataFrame([(1, None), (2, None)], "item_id long, state string")
    got = sorted((r.item_id, r.state) for r in FS.seed_or_resume(existing, seed, ["item_id"]).collect())
    assert got == [(1, "Yes"), (2, None)]
    assert FS.seed_or_resume(None, seed, ["item_id"]).count() == 2


def test_state_current_latest_per_field(spark):
    log = spark.createDataFrame([(1, 1, "is_billed", "No"), (1, 3, "is_billed", "Yes"),
                                 (1, 2, "exceptions", "e"), (2, 5, "exceptions", "x")],
                                "case_id long, seq long, field string, value string")
    got = {r.case_id: (r.is_billed, r.exceptions)
           for r in state_current(log, ["is_billed", "exceptions"]).collect()}
    assert got == {1: ("Yes", "e"), 2: (None, "x")}


def test_append_state_then_current(spark):
    from billflow.operators.state import append_state
    log = spark.createDataFrame([(1, 1, "is_billed", "No")], "case_id long, seq long, field string, value string")
    more = spark.createDataFrame([("Yes", "is_billed", 2, 1)], "value string, field string, seq long, case_id long")
    cur = state_current(append_state(log, more), ["is_billed"]).first()
    assert (cur.case_id, cur.is_billed) == (1, "Yes")


def test_quoted_cells_with_line_breaks(spark, scratch):
    with open(os.path.join(scratch, "q.csv"), "w") as f:
        f.write('practice,row_text\nP,"C1\n""Payer"", Inc\nQ\n11/30/2026\n11/29/2026\n10.00"\nP2,x\n')
    rows = FS.read_text_table(spark, os.path.join(scratch, "q.csv")).collect()
    assert [r.practice for r in rows] == ["P", "P2"]
    assert rows[0].row_text.split("\n")[1] == '"Payer", Inc' and rows[0].row_text.count("\n") == 5


def test_rerun_leaves_no_stale_route(spark, scratch):
    df = spark.createDataFrame([(1, "manual"), (2, "exception")], "item_id int, route string")
    day, other = dt.date(2026, 11, 30), dt.date(2026, 11, 29)
    FS.write_routes(df, scratch, other)
    FS.write_routes(df, scratch, day)
    FS.write_routes(df.filter("route = 'manual'"), scratch, day)
    assert [r.item_id for r in FS.read_run(spark, scratch, day).collect()] == [1]
    assert FS.read_run(spark, scratch, other).count() == 2
    FS.clear_run(spark, scratch, day)
    assert FS.read_run_or_none(spark, scratch, day) is None
    assert FS.read_run(spark, scratch, other).count() == 2


def test_only_an_absent_path_reads_as_empty(spark, scratch):
    schema = spark.range(1).schema
    assert FS.read_if_exists(spark, os.path.join(scratch, "none"), schema).count() == 0
    with open(os.path.join(scratch, "bad.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        FS.read_if_exists(spark, os.path.join(scratch, "bad.parquet"), schema).count()


def test_codes_that_are_no_numbers_stop_the_run(spark):
    sheet = spark.createDataFrame([("H0031",), ("993.0",), (None,)], "kept_cpts string")
    with pytest.raises(Exception, match="not a number: H0031"):
        rules_long(sheet, {"kept_cpts": "kept_cpts"}).collect()
    ok = rules_long(sheet.filter("kept_cpts is distinct from 'H0031'"), {"kept_cpts": "kept_cpts"})
    assert [r.value for r in ok.collect()] == ["993"]


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
