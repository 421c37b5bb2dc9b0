"""The snapshot of the state log against reducing the whole log."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from billflow import jobs as J
from billflow.operators.state import state_current
from billflow.sources import snapshots as S
from tests.test_no_broadcast import NO_BROADCAST

FIELDS = ["is_billed", "exceptions", "submitted"]


def write_day(spark, log, day, rows):
    (spark.createDataFrame(rows, J.STATE).coalesce(1).write.mode("overwrite")
     .parquet(f"{log}/run_date={day}/stage=casework"))


def day_rows(day, n=60, seq=None):
    rng = random.Random(day)
    hot = lambda: 1 if rng.random() < 0.3 else rng.randrange(40)
    return [(hot(), seq or day * 10 + rng.randrange(3), rng.choice(FIELDS), f"v{rng.randrange(100)}") for _ in range(n)]


def expected(spark, log, cases, before=None):
    events = J.read_state(spark, log)
    cur = state_current(events.filter(F.col("seq") < before) if before else events, FIELDS)
    return sorted(map(str, cases.drop(*FIELDS).join(cur.withColumnRenamed("case_id", "item_id"), "item_id", "left")
                      .select("item_id", "note", *FIELDS).collect()))


def got(spark, log, cases, before=None):
    return sorted(map(str, S.with_current(cases, "item_id", log, FIELDS, J.STATE, before).collect()))


def forget(spark):
    """As a new application, whose catalog knows no snapshot."""
    for t in spark.catalog.listTables():
        if t.name.startswith("state_snapshot_"):
            spark.sql(f"drop table {t.name}")


@pytest.fixture()
def cases(spark):
    yield spark.createDataFrame([(i, f"n{i}", "old") for i in [*range(50), 3, None]], "item_id long, note string, is_billed string")
    forget(spark)


def test_snapshot_and_delta_equal_the_full_reduction(spark, scratch, cases):
    log = f"{scratch}/log"
    assert S.compact(spark, log, FIELDS, J.STATE) is None  # no log yet
    assert got(spark, log, cases) == sorted(
        str(r) for r in cases.select("item_id", "note", *[F.lit(None).cast("string").alias(f) for f in FIELDS]).collect())
    for day in (1, 2):
        write_day(spark, log, day, day_rows(day))
    assert got(spark, log, cases) == expected(spark, log, cases)
    first = S.compact(spark, log, FIELDS, J.STATE, buckets=8)
    forget(spark)
    assert S.usable(spark, log).snap == first and not S.uncovered(spark, log, J.STATE, first).inputFiles()
    assert got(spark, log, cases) == expected(spark, log, cases)
    assert S.compact(spark, log, FIELDS, J.STATE) is None  # nothing new
    write_day(spark, log, 3, day_rows(3))
    write_day(spark, log, 4, day_rows(4, seq=5))  # late: older than what the snapshot holds
    assert got(spark, log, cases) == expected(spark, log, cases)
    assert got(spark, log, cases, before=30) == expected(spark, log, cases, before=30)
    second = S.compact(spark, log, FIELDS, J.STATE)
    assert S.usable(spark, log).snap == second != first
    assert got(spark, log, cases) == expected(spark, log, cases)
    assert S.usable(spark, log, before=30).snap == first  # the second holds later events
    assert got(spark, log, cases, before=30) == expected(spark, log, cases, before=30)
    # a day that is run again: snapshots that hold its old events are passed over
    time.sleep(0.01)
    write_day(spark, log, 3, day_rows(33, seq=31))
    assert S.usable(spark, log).snap == first
    assert got(spark, log, cases) == expected(spark, log, cases)
    write_day(spark, log, 1, day_rows(11, seq=11))
    assert S.usable(spark, log) is None and got(spark, log, cases) == expected(spark, log, cases)
    assert J.read_state(spark, log).count() == 240  # snapshots are hidden from the log


def test_a_compaction_that_dies_is_not_seen(spark, scratch, cases, monkeypatch):
    log = f"{scratch}/log"
    write_day(spark, log, 1, day_rows(1))
    with monkeypatch.context() as m:
        m.setattr(F, "current_timestamp", lambda: 1 / 0)  # the state is written, its list of files is not
        with pytest.raises(ZeroDivisionError):
            S.compact(spark, log, FIELDS, J.STATE, buckets=8)
    assert os.listdir(f"{log}/_snapshots") == ["state"] and S.usable(spark, log) is None
    assert got(spark, log, cases) == expected(spark, log, cases)
    assert S.compact(spark, log, FIELDS, J.STATE, buckets=8) == S.usable(spark, log).snap


def test_the_snapshot_is_read_and_merged_without_a_shuffle(spark, scratch, cases):
    log = f"{scratch}/log"
    write_day(spark, log, 1, day_rows(1))
    old = S.compact(spark, log, FIELDS, J.STATE, buckets=8)
    write_day(spark, log, 2, day_rows(2))
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        df = S.with_current(cases, "item_id", log, FIELDS, J.STATE)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(i for i, x in enumerate(lines) if f"state_snapshot_{old}" in x)
        assert "Bucketed: true" in lines[at]
        # above the scan up to its join: a sort at most
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        chain, d = [], depth(lines[at])
        for x in reversed(lines[:at]):
            if depth(x) < d:
                d = depth(x)
                chain.append(x)
                if "Join" in x:
                    break
        assert "Join" in chain[-1] and not any("Exchange" in x for x in chain), chain
        assert got(spark, log, cases) == expected(spark, log, cases)
        new = S.compact(spark, log, FIELDS, J.STATE)
        files = [f for f in os.listdir(f"{log}/_snapshots/state/{new}") if f.endswith(".parquet")]
        assert 0 < len(files) <= 8  # one a bucket at most
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
