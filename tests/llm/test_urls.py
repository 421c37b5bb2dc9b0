"""URL filters against a replay of the list's log."""

import random
import re

from billflow.llm import urls as U

from .conftest import by_id

ENTRY = "list string, key string, day int, adds boolean, id string"
CAPTURE = "page_id long, url string, day int, host string, key string, list string"


def brute(captures, entries):
    days: dict = {}
    for kind, key, day, adds in entries:
        if kind and key and day is not None:
            log = days.setdefault((kind, key), {})
            log[day] = log.get(day, True) and bool(adds)
    out: dict = {}
    for page, url, day in captures:
        m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", (url or "").lower())
        host = m[1] if m else None
        met = []
        if host and day is not None:
            parts = host.split(".")
            keys = [".".join(parts[i:]) for i in range(max(1, len(parts) - 1))]
            for (kind, key), log in days.items():
                past = [d for d in log if d <= day]
                if key in keys and past and log[max(past)]:
                    met.append((len(key), kind == "allow", key))
        top = max(met, default=None)
        out.setdefault(page, []).append((host, day, len(met), top and top[2], bool(top and not top[1])))
    return out


def run(spark, captures, entries):
    c = spark.createDataFrame([(*x, "h", "k", "l") for x in captures], CAPTURE)
    e = spark.createDataFrame([(*x, "z") for x in entries], ENTRY)
    return U.evaluate(c, e, "page_id", "url", "day")


def test_matches_a_replay(spark):
    rng = random.Random(6)
    hosts = ["a.example.com", "b.example.com", "x.y.example.org", "localhost", "d.net"]
    keys = hosts + ["example.com", "example.org", "y.example.org", "com"]
    entries = [(rng.choice(["block", "allow"]), rng.choice(keys), rng.randrange(0, 700), rng.random() < 0.6) for _ in range(150)]
    entries += [entries[0], ("block", None, 3, True), (None, "d.net", 3, True), ("block", "d.net", None, True),
                ("block", "d.net", 5, None)]
    captures = [(i, f"https://{rng.choice(['', 'www.', 'u:p@'])}{'hot.example.com' if i % 3 else rng.choice(hosts)}:8/p?q",
                 rng.randrange(-5, 800)) for i in range(600)]
    captures += [(1, captures[1][1], captures[1][2]), (700, None, 3), (701, "no url", 3), (702, "http://d.net", None),
                 (None, "HTTP://D.NET/", 90), (703, "", 1), (704, "http://" + "a." * 3000 + "com", 50)]
    got = by_id(run(spark, captures, entries), "page_id")
    key = lambda x: tuple((v is not None, v) for v in x)
    want = brute(captures, entries)
    assert got.keys() == want.keys()
    for p in want:
        assert sorted((tuple(r)[1:] for r in got[p]), key=key) == sorted(want[p], key=key), p


def test_empty_tables(spark):
    one = [(1, "http://a.b/", 3)]
    r, = run(spark, one, []).collect()
    assert (r.n_active, r.decided_by, r.blocked) == (0, None, False)
    assert run(spark, [], [("block", "a.b", 1, True)]).count() == 0
    r, = run(spark, one, [("block", "a.b", 3, True)]).collect()
    assert r.blocked and r.decided_by == "a.b"


def test_far_and_negative_days(spark):
    """Days apart by billions make no more rows than the captures have, and open entries hold to the last."""
    captures = [(1, "http://a.b/", 7), (2, "http://a.b/", 2_000_000_000), (3, "http://a.b/", -2_000_000_000),
                (4, "http://c.d/", -70), (5, "http://c.d/", -64), (6, "http://c.d/", -1), (7, "http://c.d/", 0)]
    entries = [("block", "a.b", 3, True), ("block", "c.d", -70, True), ("block", "c.d", -64, False),
               ("allow", "c.d", -1, True), ("block", "c.d", -2, True), ("block", "a.b", -2_147_483_648, True)]
    got = by_id(run(spark, captures, entries), "page_id")
    want = brute(captures, entries)
    assert {p: [tuple(r)[1:] for r in rs] for p, rs in got.items()} == want
    assert [got[i][0].blocked for i in range(1, 8)] == [True, True, True, True, False, False, False]


def test_rows_without_a_host_are_spread(spark):
    captures = [(i, None, 3) for i in range(400)] + [(i, "http://hot.com/", 5) for i in range(400, 800)]
    got = run(spark, captures, [("block", "hot.com", 1, True)])
    assert got.filter("blocked").count() == 400 and got.count() == 800
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_left_salt" in plan
