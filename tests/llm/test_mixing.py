"""Mixing against a loop that reshares the excess, and what documents are taken."""

import hashlib
import re
from math import floor

import pytest

from billflow.llm import mixing as X

from .conftest import by_id, documents


def loop(sizes):
    """Targets by resharing the excess until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    total = sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        if not free:
            return target
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        full |= above
        target |= {s: 3.0 * sizes[s] for s in above}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, seed=X.SEED):
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = loop(sizes)
    out, number = {}, {}
    for d, t, s in rows:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        key = f"{seed}|{'\\N' if d is None else d}|{hashlib.md5((t or '').encode()).hexdigest()}"
        n = number[d, s, t or ""] = number.get((d, s, t or ""), -1) + 1
        u = (int(hashlib.md5(key.encode()).hexdigest()[:12], 16) / 16 ** 12 + n * X.GOLDEN) % 1
        out.setdefault(d, []).append((size(t), sizes[s], target[s], floor(rate) + (u < rate - floor(rate))))
    return out


def cases():
    yield [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(300)]
    yield [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"é{i % 11}") for i in range(300)]
    yield [(0, "a b c", "only")]
    yield [(1, None, "a"), (2, "", "b"), (3, " \n", None)]
    yield [(1, "x", "b"), (1, "x", "b"), (None, "x y", None), (4, "z " * 30_000, "B"), (5, None, "a")]


@pytest.mark.parametrize("rows", list(cases()), ids=range(5))
def test_matches_the_loop(spark, rows):
    got = by_id(X.mix(documents(spark, rows)).select("row.doc_id", "size", "source_size", "target", "copies"))
    want = brute(rows)
    assert got.keys() == want.keys()
    for d in want:
        for r, w in zip(sorted(got[d], key=lambda r: r.size), sorted(want[d])):
            assert (r.size, r.source_size, r.copies) == (w[0], w[1], w[3])
            assert r.target == pytest.approx(w[2], rel=1e-12)
            assert r.copies <= 3


def test_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{i % 4}") for i in range(6000)]
    taken: dict = {}
    for d, rs in brute(rows).items():
        s = f"s{d % 4}"
        taken[s] = (taken.get(s, (0,))[0] + rs[0][0] * rs[0][3], rs[0][2])
    assert all(abs(t - goal) < 0.1 * goal for t, goal in taken.values())


def test_take_keeps_rows(spark, messy, empty):
    copies = {d: sum(x[3] for x in rs) for d, rs in brute([(r.doc_id, r.text, r.source) for r in messy.collect()]).items()}
    got = X.take(messy)
    assert got.columns == messy.columns
    assert {d: len(rs) for d, rs in by_id(got).items()} == {d: n for d, n in copies.items() if n}
    assert X.take(empty).count() == 0 and X.mix(empty).count() == 0


def taken_of(df):
    out: dict = {}
    for r in X.mix(df, keep=["doc_id", "source"]).select("row.source", "size", "target", "copies").collect():
        got = out.setdefault(r.source, [0, r.target])
        got[0] += r.size * r.copies
    return out


@pytest.mark.parametrize("ids", ["null", "one", "alike"])
def test_targets_hold_without_ids_of_their_own(spark, ids):
    """Half the rows without an id, on one id, or copies of one row: sources still come near their targets."""
    rows = [(i if i % 2 else {"null": None, "one": 7, "alike": 7}[ids], "w " * 10 if ids == "alike" and i % 2 == 0 else "w " * (1 + i % 20) + str(i),
             f"s{i % 8 // 2}") for i in range(8000)]
    got = taken_of(documents(spark, rows).repartition(5))
    assert len(got) == 4 and all(abs(t - goal) < 0.05 * goal for t, goal in got.values()), got


def test_copies_of_a_row_are_taken_in_the_same_number_however_they_lie(spark):
    rows = [(1, "a b c", "x")] * 500 + [(2, "d e", "y")] * 40 + [(i, f"{i} z", "xyz"[i % 3]) for i in range(3, 200)]
    count = lambda df: sorted(map(tuple, X.mix(df).select("row.doc_id", "copies").collect()))
    assert count(documents(spark, rows).repartition(7)) == count(documents(spark, rows[::-1]).coalesce(1))


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_any_number_of_sources(spark, monkeypatch, limit):
    """Ranges of sources instead of one task, and joins by source, give what the loop gives."""
    monkeypatch.setattr(X, "RANGE", 7)
    monkeypatch.setattr(X, "broadcast_row_limit", lambda df: limit)
    rows = [(i, "w " * (1 + i * i % 37), f"s{i % 60}" if i % 9 else None) for i in range(700)]
    got = by_id(X.mix(documents(spark, rows)).select("row.doc_id", "size", "source_size", "target", "copies"))
    want = brute(rows)
    assert all((got[d][0].source_size, got[d][0].copies) == (want[d][0][1], want[d][0][3]) for d in want)
    assert all(got[d][0].target == pytest.approx(want[d][0][2], rel=1e-12) for d in want)
