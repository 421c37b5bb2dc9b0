"""Incremental arrivals with a checkpointed AvailableNow stream."""

import datetime as dt
import os

import pytest

from billflow.plans.remit import read_ledger
from billflow.schema import REMIT_LEDGER
from billflow.sources import commits as C
from billflow.sources.files import read_text_table
from billflow.streaming import arrivals as A


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write("a,b\n" + "".join(f"{x},{y}\n" for x, y in rows))


def test_available_now_picks_only_new_files(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    _write(src, "one.csv", [("1", "x"), ("NA", "y")])
    A.land_new_exports(spark, src, ["a", "b"], out, ckpt)
    assert spark.read.parquet(out).count() == 2
    _write(src, "two.csv", [("3", "z")])
    A.land_new_exports(spark, src, ["a", "b"], out, ckpt)
    df = spark.read.parquet(out)
    assert df.count() == 3
    assert df.filter("a IS NULL").count() == 1  # NA token mapped to NULL
    assert df.filter(df.source_file.endswith("two.csv")).count() == 1


def test_ledger_sink_is_idempotent(spark, scratch):
    day = dt.date(2026, 11, 30)
    rows = [("C1", "p", "q", "11/30/2026", "1.00", "File Downloaded", "R"),
            ("C1", "p", "q", "11/30/2026", "1.00", "File Downloaded", "R"),
            ("C2", "p", "q", "11/30/2026", "2.00", "File Not Downloaded", "R")]
    batch = spark.createDataFrame(rows, REMIT_LEDGER)
    sink = A.ledger_sink(scratch, day)
    sink(batch, 0)
    sink(batch, 0)  # replayed batch
    got = read_ledger(spark, scratch, day)
    assert sorted(r.check_no for r in got.collect()) == ["C1", "C2"]


def test_watermark_dedupe_of_checks(spark, scratch):
    import datetime as _dt
    src = os.path.join(scratch, "rows")
    t0 = _dt.datetime(2026, 11, 30, 9, 0, 0)
    rows = [("C1", t0), ("C1", t0 + _dt.timedelta(minutes=5)), ("C2", t0)]
    spark.createDataFrame(rows, "check_no string, arrived_at timestamp").write.parquet(src)
    stream = spark.readStream.schema("check_no string, arrived_at timestamp").parquet(src)
    q = (A.dedupe_checks_stream(stream).writeStream.format("memory").queryName("dedupe_checks")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.check_no for r in spark.sql("SELECT check_no FROM dedupe_checks").collect())
    assert got == ["C1", "C2"]


def test_the_stream_reads_what_the_batch_reads(spark, scratch):
    """Quoted cells with line breaks, doubled quotes and separators, split by neither."""
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "one.csv"), "w", newline="") as f:
        f.write('a,b\n1,"two\nlines, and ""quotes"""\nNA,"x\r\ny"\n"",z\n')
    A.land_new_exports(spark, src, ["a", "b"], out, ckpt)
    batch = read_text_table(spark, src, ["a", "b"])
    rows = lambda df: sorted((r.a or "", r.b) for r in df.collect())
    assert rows(spark.read.parquet(out)) == rows(batch)
    assert len(rows(batch)) == 3


def test_a_batch_that_died_shows_nothing(spark, scratch, monkeypatch):
    day = dt.date(2026, 11, 30)
    batch = spark.createDataFrame([("C1", "p", "q", "11/30/2026", "1.00", "File Downloaded", "R")], REMIT_LEDGER)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(C, "_announce", lost)
        with pytest.raises(OSError):
            A.ledger_sink(scratch, day)(batch, 7)
    assert read_ledger(spark, scratch, day).isEmpty()
    for _ in range(2):
        A.ledger_sink(scratch, day)(batch, 7)
    assert read_ledger(spark, scratch, day).count() == 1
