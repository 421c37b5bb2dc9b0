"""The ledger stream with state: start from the ledger, replays, restarts, closed days."""

import datetime as dt
import os

import pytest

from billflow.plans.remit import read_ledger
from billflow.schema import REMIT_LEDGER
from billflow.sources import commits as C
from billflow.streaming import ledger as L

DAY = dt.date(2026, 11, 30)


def put(spark, folder, rows):
    """(day, check, payer) rows as one new file of the stream's folder."""
    full = [(day, check, payer, "q", "11/30/2026", "1.00", "File Downloaded", "R") for day, check, payer in rows]
    spark.createDataFrame(full, L.ROW).coalesce(1).write.mode("append").parquet(folder)


def run(spark, scratch, ledger=(), **kw):
    start = spark.createDataFrame(list(ledger), "run_date date, check_no string")
    stream = spark.readStream.schema(L.ROW).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    return L.land_unseen(stream, start, f"{scratch}/ledger", f"{scratch}/ckpt", **kw)


def landed(spark, scratch, day=DAY):
    return sorted((r.check_no or "", r.payer) for r in read_ledger(spark, f"{scratch}/ledger", day).collect())


def test_state_starts_from_the_ledger_and_goes_on(spark, scratch):
    put(spark, f"{scratch}/in", [(DAY, "C1", "a"), (DAY, "C2", "b"), (DAY, "C2", "a"), (DAY, None, "n"), (None, "C9", "x")])
    run(spark, scratch, [(DAY, "C1"), (DAY, "C1"), (DAY, None), (DAY - dt.timedelta(1), "C2")])
    assert landed(spark, scratch) == [("", "n"), ("C2", "a")]  # of equal checks the least row; the day before is another
    put(spark, f"{scratch}/in", [(DAY, "C2", "a"), (DAY, "C3", "c"), (DAY, "C1", "z")])
    run(spark, scratch)  # restarted: the state is the checkpoint's, not the ledger given
    assert landed(spark, scratch) == [("", "n"), ("C2", "a"), ("C3", "c")]
    run(spark, scratch)  # nothing new
    assert len(landed(spark, scratch)) == 3


def test_a_batch_that_died_is_replayed_once(spark, scratch, monkeypatch):
    put(spark, f"{scratch}/in", [(DAY, "C1", "a"), (DAY, "C2", "b")])

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(C, "_announce", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, scratch)
    assert not os.path.exists(f"{scratch}/ledger/_commits") and landed(spark, scratch) == []
    for _ in range(2):
        run(spark, scratch)
        assert landed(spark, scratch) == [("C1", "a"), ("C2", "b")]


def test_a_batch_published_but_not_committed_is_not_published_again(spark, scratch, monkeypatch):
    put(spark, f"{scratch}/in", [(DAY, "C1", "a")])
    real = L.publish

    def then_lost(*a):
        real(*a)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(L, "publish", then_lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, scratch)
    run(spark, scratch)
    assert landed(spark, scratch) == [("C1", "a")]


def test_closed_days_leave_no_state(spark, scratch):
    put(spark, f"{scratch}/in", [(DAY, f"C{i}", "a") for i in range(5)])
    run(spark, scratch)
    seen = lambda: spark.read.format("statestore").option("stateVarName", "seen").load(f"{scratch}/ckpt").count()
    assert seen() == 5
    later = DAY + dt.timedelta(9)
    put(spark, f"{scratch}/in", [(later, "C1", "b")])
    run(spark, scratch)
    put(spark, f"{scratch}/in", [(later, "C1", "c"), (later, "C2", "c"), (DAY, "C1", "late")])
    run(spark, scratch)
    assert seen() == 2
    assert landed(spark, scratch, later) == [("C1", "b"), ("C2", "c")]
    assert landed(spark, scratch) == [(f"C{i}", "a") for i in range(5)]


def test_equal_to_the_batch_operator(spark, scratch):
    """Many repeats of one check over several files, against the set of checks."""
    rows = [(DAY, "hot" if i % 3 == 0 else f"C{i % 40}", f"p{i % 7}") for i in range(600)]
    for lo in range(0, 600, 200):
        put(spark, f"{scratch}/in", rows[lo:lo + 200])
    run(spark, scratch, [(DAY, f"C{i}") for i in range(10)])
    want = {c for _, c, _ in rows} - {f"C{i}" for i in range(10)}
    got = [c for c, _ in landed(spark, scratch)]
    assert len(got) == len(set(got)) and set(got) == want
    assert [f.name for f in read_ledger(spark, f"{scratch}/ledger", DAY).schema] == [f.name for f in REMIT_LEDGER]
