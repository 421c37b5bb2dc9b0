"""Line dedup against plain Python, in both ways of joining, and against its SQL."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billflow.llm import lines as L

from .conftest import by_id, documents

TRIM = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(rows, ratio=L.RATIO):
    """[(id, text, host)] -> id -> (n_lines, n_dropped, text left); repeated ids in order."""
    pages = Counter(h for _, _, h in rows)
    on: Counter = Counter()
    for _, t, h in rows:
        on.update((h, x) for x in {x.strip(TRIM) for x in (t or "").split("\n")} if x)
    out: dict = {}
    for d, t, h in rows:
        lines = (t or "").split("\n")
        gone = lambda x: h is not None and on[h, x] > 1 and on[h, x] > ratio * pages[h]
        left = [x for x in lines if not (x.strip(TRIM) and gone(x.strip(TRIM)))]
        if not any(x.strip(TRIM) for x in left):
            left = lines
        out.setdefault(d, []).append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def site(n=60):
    rows = []
    for i in range(n):
        body = [f"own line {i}", "  shared footer ", "", "rare line" if i < 4 else f"other {i}", "menu | home"]
        rows.append((i, "\n".join(body), ["big", "big", "small", None][i % 4] if i > 3 else "tiny"))
    rows += [(900 + i, "shared footer\nmenu | home", "big") for i in range(3)]  # nothing but boilerplate
    return rows + [(990, None, "big"), (991, "", "big"), (992, "x " * 50_000 + "\nshared footer\t", "big")]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_matches_plain_python(spark, monkeypatch, broadcast):
    monkeypatch.setattr(L, "BROADCAST_LINES", broadcast)
    rows = site()
    df = documents(spark, rows)
    got = by_id(L.drop_lines(df, F.col("source"), F.col("text"), df.columns).select("row.doc_id", "n_lines", "n_dropped", "clean"))
    assert {d: sorted((r.n_lines, r.n_dropped, r.clean) for r in rs) for d, rs in got.items()} == brute(rows)
    assert got[0][0].n_dropped == 3 and got[4][0].n_dropped == 2


def test_pages_of_boilerplate_alone_are_told(spark):
    df = documents(spark, site())
    got = by_id(L.drop_lines(df, F.col("source"), F.col("text"), df.columns)
                .select("row.doc_id", "n_lines", "n_dropped", "n_over"))
    assert [(r.n_lines, r.n_dropped, r.n_over) for d in (900, 4, 0, 990) for r in got[d]] == [
        (2, 0, 2), (5, 2, 2), (5, 3, 3), (1, 0, 0)]


def test_odd_rows(messy, empty):
    got = L.drop_lines(messy, F.col("source"), F.col("text"), messy.columns)
    assert got.count() == 12 and got.agg(F.sum("n_dropped")).first()[0] == 0
    assert L.drop_lines(empty, F.col("source"), F.col("text"), empty.columns).count() == 0


def test_html_lines_and_hosts(spark):
    html = '<html><head><title>T &amp; x</title><style>p{}</style></head><body><p>one<b>two</b>\n</p><br/>3<!-- no --><script>var a="</p>"</script></body>'
    urls = {"http://www.A.example.com:80/x": "a.example.com", "https://u@b.org?q": "b.org", "mailto:x@y.z": None, "": None}
    df = spark.createDataFrame([(html, u) for u in urls], "html string, url string")
    got = df.select(L.html_lines(F.col("html")).alias("t"), L.host_of(F.col("url")).alias("h")).collect()
    assert [x.strip() for x in got[0].t.split("\n") if x.strip()] == ["T &amp; x", "onetwo", "3"]
    assert [r.h for r in got] == list(urls.values())
    assert not re.search("[<>]", got[0].t)


@pytest.mark.parametrize("pages", range(2, 10))
def test_small_hosts_are_treated_alike(spark, pages):
    """A menu that stands on all pages of a host goes, however few they are; lines of one page stay."""
    rows = [(i, f"menu\nown {i}\nfooter", "few") for i in range(pages)] + [(99, "menu\nown 99\nfooter", "one")]
    got = by_id(L.drop_lines(documents(spark, rows), F.col("source"), F.col("text"), ["doc_id"]).select("row.doc_id", "n_dropped", "clean"))
    assert all((got[i][0].n_dropped, got[i][0].clean) == (2, f"own {i}") for i in range(pages))
    assert got[99][0].n_dropped == 0
