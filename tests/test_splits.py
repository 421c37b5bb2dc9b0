"""The split reader against the one-task reader, with a split at every offset."""

import random

import pytest

from billflow.schema import NA_TOKENS
from billflow.sources import splits as S
from billflow.sources.files import read_text_table

CELLS = ["a", "", "NaN", 'say ""hi""', "two\nlines", "\n", "x,y", "crlf\r\nin", '""', "é", "\n\n\"\"\n", " b "]


def quoted(c):
    return f'"{c}"' if any(x in c for x in ',\n"') or c == "" else c


def export(path, rows, end="\n", last=True):
    body = [",".join(map(quoted, r)) for r in rows]
    with open(path, "w", newline="") as f:
        f.write(end.join(['id,text,"no\nte"', *body]) + (end if last else ""))
    return path


def cells(df):
    return [tuple(r) for r in df.collect()]


def meant(rows):
    """What the rows say, whatever the line ends (the one-task reader takes the first line end
    of a file, be it in a cell, for that of all records, and leaves CR in the last cells)."""
    return [tuple(None if c in NA_TOKENS else c.replace('""', '"') for c in r) for r in rows]


def sized(spark, n):
    """Splits of n bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set(S.MIN_PARTITIONS, "1")


@pytest.fixture()
def conf(spark):
    yield spark
    for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", S.MIN_PARTITIONS):
        spark.conf.unset(c)


@pytest.mark.parametrize("end,sizes", [("\n", (1, 2, 3, 5, 11, 29, 1000)), ("\r\n", (1, 4, 7, 64))])
def test_a_split_at_every_offset(conf, scratch, end, sizes):
    """With one file of n bytes and splits of k, every byte is the start of a split for some k."""
    rng = random.Random(1)
    rows = [[str(i), rng.choice(CELLS), rng.choice(CELLS)] for i in range(7)] + [["7", "\n" * 9, "end"], ["8", "a", "b"]]
    path = export(f"{scratch}/a.csv", rows, end=end, last=False)
    want = meant(rows)
    assert end != "\n" or cells(read_text_table(conf, path)) == want
    for size in sizes:
        sized(conf, size)
        df = S.read_split_table(conf, path, place=True)
        got = [tuple(r)[:3] for r in sorted(df.collect(), key=lambda r: r._place)]
        assert got == want, size
        assert df.columns == ["id", "text", "no\nte", "_file", "_place"]


def test_many_files_and_many_tasks(conf, scratch):
    rng = random.Random(2)
    want = []
    for f in range(3):
        rows = [[f"{f}-{i}", rng.choice(CELLS), rng.choice(CELLS)] for i in range(400)]
        export(f"{scratch}/{f}.csv", rows, end=["\n", "\r\n", "\n"][f], last=f != 1)
        want += meant(rows)
    want.sort(key=str)
    for size in (500, 3000, 1 << 20):
        sized(conf, size)
        assert sorted(cells(S.read_split_table(conf, scratch)), key=str) == want
    sized(conf, 500)
    assert S._lines(conf, scratch).rdd.getNumPartitions() > 20  # one file is read by many tasks
    assert read_text_table(conf, f"{scratch}/0.csv").rdd.getNumPartitions() == 1
    whole = S.read_split_table(conf, export(f"{scratch}/plain.csv", [["1", "a", "b"]] * 50))
    sized(conf, 1 << 20)
    assert "Exchange" not in S.read_split_table(conf, f"{scratch}/plain.csv")._jdf.queryExecution().executedPlan().toString()
    assert whole.count() == 50


def test_odd_files(conf, scratch):
    sized(conf, 6)
    with open(f"{scratch}/h.csv", "w") as f:
        f.write("a,b\n")
    assert S.read_split_table(conf, f"{scratch}/h.csv").collect() == []
    with open(f"{scratch}/r.csv", "w") as f:
        f.write('a,b\n1\n\n2,x,more\n3,"open\nto the end')
    got = sorted(cells(S.read_split_table(conf, f"{scratch}/r.csv")), key=str)
    assert got == sorted(cells(read_text_table(conf, f"{scratch}/r.csv")), key=str) and len(got) == 3
    with open(f"{scratch}/s.csv", "w") as f:
        f.write('a,b\n1,a 5" pipe and a 6" pipe\n')
    with pytest.raises(Exception, match="inside an unquoted cell"):
        S.read_split_table(conf, f"{scratch}/s.csv").collect()
