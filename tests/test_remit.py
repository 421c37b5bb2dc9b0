"""Remittance parsing, reconciliation, and the rerun property of the ledger."""

import datetime as dt
import os

import pytest

from billflow.operators import remit as R
from billflow.plans import bindings as B
from billflow.plans import registry as RG
from billflow.plans.remit import ledger_delta, read_ledger, read_rejects, read_worked, run_remit
from billflow.schema import (WL_NO_EOBS, WL_PRACTICE_NOT_FOUND, WL_PROCESSED, WL_STATE_NOT_FOUND, WL_UNMATCHED)
from billflow.sources import commits as C
from tests.conftest import SF_SMALL


def test_parse_short_row_is_flagged(spark):
    df = spark.createDataFrame([(1, "C1\nP\nQ\n11/30/2026\n11/29/2026\n10.00"), (2, "C2\nP\nQ")],
                               "item_id long, row_text string")
    out = {r.item_id: r for r in R.parse_remit_row(df).collect()}
    assert out[1].parse_ok and out[1].amount == "10.00" and out[1].received_date == "11/29/2026"
    assert not out[2].parse_ok and out[2].check_date is None
    assert [r.item_id for r in R.parse_rejects(df).collect()] == [2]


def test_window_either_date(spark):
    df = spark.createDataFrame([(1, "11/30/2026", "01/01/2000"), (2, "01/01/2000", "11/29/2026"),
                                (3, "11/28/2026", None)], "item_id long, received_date string, check_date string")
    got = sorted(r.item_id for r in R.remit_window(df, dt.date(2026, 11, 30)).collect())
    assert got == [1, 2]


def test_unseen_checks_ignores_status_and_keeps_in_run_repeats(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "item_id long, check_no string")
    ledger = spark.createDataFrame([("B", "File Not Downloaded")], "check_no string, status string")
    assert sorted(r.item_id for r in R.unseen_checks(rows, ledger).collect()) == [1, 2]
    assert R.unseen_checks(rows, ledger, dedupe=True).count() == 1


def run(spark, scratch, **more):
    return run_remit(spark, B.remit_rows(spark, SF_SMALL), B.worklist(spark, SF_SMALL), B.known_states(spark, SF_SMALL),
                     B.known_practices(spark, SF_SMALL), RG.downloaded(spark, SF_SMALL), scratch, B.ASOF, **more)


def test_rerun_adds_nothing(spark, scratch):
    first = run(spark, scratch)
    assert first > 0 and run(spark, scratch) == 0
    ledger = read_ledger(spark, scratch, B.ASOF)
    assert ledger.count() == first
    statuses = {r.status for r in ledger.select("status").distinct().collect()}
    assert statuses <= {"File Downloaded", "File Not Downloaded"}
    assert read_rejects(spark, scratch, B.ASOF).count() > 0


def test_only_the_login_s_rows_are_worked(spark, scratch):
    one = run(spark, scratch, login="login1")
    done = read_worked(spark, scratch, B.ASOF)
    assert {r.login for r in done.collect()} == {"login1"}
    assert one > 0 and run(spark, scratch, login="login1") == 0 < run(spark, scratch)


def test_a_ledger_that_cannot_be_read_is_no_empty_ledger(spark, scratch):
    os.makedirs(f"{scratch}/_commits/run_date=11302026")
    with open(f"{scratch}/_commits/run_date=11302026/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        run(spark, scratch)
    C._announce(spark, f"{scratch}/lost", B.ASOF, [("r", "ledger", "_data/gone")])  # published, and its files are gone
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, f"{scratch}/lost")


def test_worklist_statuses(spark):
    got = {r.wl_status for r in RG.q_worklist_status(spark, SF_SMALL).collect()}
    assert got == {WL_STATE_NOT_FOUND, WL_UNMATCHED, WL_PRACTICE_NOT_FOUND, WL_NO_EOBS, WL_PROCESSED}


def test_rsm_of_the_row_that_is_worked(spark):
    wl = spark.createDataFrame([("l", "Nowhere", "A", "P", 0), ("l", "State 1", "B", "P", 1), ("l", "State 1", "C", "P", 2)],
                               "login string, state_name string, rsm string, practice string, position int")
    rows = spark.createDataFrame([("P", "C1\np\nq\n11/30/2026\n01/01/2000\n1.00"),
                                  ("P", "C2\np\nq\n01/01/2000\n11/30/2026\n1.00")], "practice string, row_text string")
    states = spark.createDataFrame([("State 1",)], "state_name string")
    status = R.worklist_status(wl, states, wl.select("practice"), rows, B.ASOF)
    none = spark.createDataFrame([], "check_no string, path string")
    got = ledger_delta(rows, status, none, none, B.ASOF).collect()
    assert [(r.check_no, r.rsm) for r in got] == [("C1", "B")]  # C2 was not shown by the search
    late = rows.filter("row_text like 'C2%'")
    assert {r.wl_status for r in R.worklist_status(wl, states, wl.select("practice"), late, B.ASOF).collect()} == \
        {WL_STATE_NOT_FOUND, WL_NO_EOBS}


def state_of(spark, root):
    return [sorted(map(str, read(spark, root, B.ASOF).collect())) for read in (read_ledger, read_rejects, read_worked)]


@pytest.mark.parametrize("stop", range(4))
def test_a_run_that_stops_anywhere_is_seen_in_full_or_not_at_all(spark, scratch, monkeypatch, stop):
    """Stop after each write (the last: before the manifest); nothing shows, and the rerun does it all, once."""
    run(spark, f"{scratch}/clean")
    want = state_of(spark, f"{scratch}/clean")
    done = []

    def stage(df, root, path, write=C.stage):
        if len(done) == stop:
            raise OSError("lost")
        write(df, root, path)
        done.append(path)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(C, "stage", stage)
        if stop == 3:
            m.setattr(C, "_announce", lost)
        with pytest.raises(OSError):
            run(spark, f"{scratch}/died")
    assert len(done) == stop and state_of(spark, f"{scratch}/died") == [[], [], []]
    assert run(spark, f"{scratch}/died") == len(want[0]) > 0
    assert state_of(spark, f"{scratch}/died") == want
    assert run(spark, f"{scratch}/died") == 0 and state_of(spark, f"{scratch}/died") == want


def test_a_run_id_is_published_once(spark, scratch):
    one = run(spark, scratch, login="login0", run="morning")
    assert one > 0
    before = state_of(spark, scratch)
    assert not C.publish(spark, scratch, B.ASOF, "morning", {"ledger": read_ledger(spark, scratch, B.ASOF)})
    assert state_of(spark, scratch) == before
