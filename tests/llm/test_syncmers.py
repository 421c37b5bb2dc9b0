"""Syncmers against their definition; the edited texts against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from billflow.llm import syncmers as Y

from .conftest import by_id, documents


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def naive(text, k, s):
    codes = Y._codes(text)
    inner = [int(Y.mix64(Y._rolled(codes[i:i + s], s))[0]) for i in range(len(codes) - s + 1)]
    out = []
    for i in range(len(codes) - k + 1):
        w = inner[i:i + k - s + 1]
        if min(w) in (w[0], w[-1]):
            out.append(i)
    return out


@pytest.mark.parametrize("k,s", [(20, 13), (8, 5), (7, 7), (12, 4)])
def test_definition(k, s):
    rng = random.Random(k)
    for n in (0, 1, 3, 40):
        t = words(rng, n)
        at, h = Y.syncmers(Y._codes(t), k, s)
        assert at.tolist() == (naive(t, k, s) if len(t) >= k else [])
        seen = {}
        for p, x in zip(at.tolist(), h.tolist()):
            assert seen.setdefault(t[p:p + k], x) == x


def test_anchors_do_not_depend_on_context():
    rng = random.Random(3)
    t = words(rng, 60)
    inside = dict(zip(*(x.tolist() for x in Y.anchors_of("zz" + t + "qq"))))
    at, h = Y.anchors_of(t)
    assert len(at) and all(inside[p + 2] == x for p, x in zip(at.tolist(), h.tolist()))


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2 ** 32, 40_000).astype(np.uint32))
    rng.shuffle(pool)
    for share in (0.1, 0.5, 0.9):
        n = int(10_000 * share)
        a, b = pool[:10_000], np.concatenate([pool[:n], pool[10_000:20_000 - n]])
        true = n / (20_000 - n)
        assert abs(Y.likeness(Y.smallest(a), Y.smallest(b)) - true) < 0.15
    assert Y.smallest(np.repeat(pool[:50], 100)).tolist() == sorted(pool[:50].tolist())


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    out = {}
    for i, (d, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(t) - len(t) // 4
        edited = t[:cut] + nxt[:len(t) // 4]
        out[d] = (t, edited, nxt)
    return out


@pytest.mark.parametrize("per_part", [3, 4000])
def test_edited_texts(spark, monkeypatch, per_part):
    rng = random.Random(5)
    rows = [(i * 3, words(rng, rng.choice([0, 1, 2, 30, 200])) if i % 9 else None, "s") for i in range(60)]
    rng.shuffle(rows)
    monkeypatch.setattr(Y.with_next, "__defaults__", (per_part,))
    got = by_id(Y.fingerprint_edited(documents(spark, rows).repartition(7)))
    for d, (t, edited, nxt) in expected(rows).items():
        r, = got[d]
        fp = [Y.smallest(Y.anchors_of(x)[1]) for x in (t, edited, nxt)]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (Y.printed(fp[0]), Y.printed(fp[1]))
        assert r.near_edited == Y.likeness(fp[0], fp[1]) and r.near_next == Y.likeness(fp[0], fp[2])
        assert 0 <= r.near_edited <= 1 and (r.n_chars < 200 or r.near_edited > 0.4 > r.near_next)


def test_odd_rows(spark, messy, empty):
    got = by_id(Y.fingerprint_edited(messy))
    assert sum(map(len, got.values())) == 12 and got[2][0].fingerprint == "" and None in got
    assert got[1][0].fingerprint == got[1][1].fingerprint
    assert Y.fingerprint_edited(empty).count() == 0
    one, = Y.fingerprint_edited(documents(spark, [(5, "abcdefgh", "s")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert len(by_id(Y.anchors(messy))[4][0].anchors) > 1000


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 64, 100])
def test_rows_are_dealt_by_the_starts_of_ranges(spark, n):
    """Each id in one range, ranges in order, the first row of each also in the one before."""
    df = spark.range(0, 3 * n, 3).selectExpr("id as doc_id", "cast(id as string) as text").repartition(3)
    rows = Y.with_next(df, "doc_id", "text", rows_per_part=2).collect()
    own = sorted((r.id, r.part) for r in rows if not r.ahead)
    assert [i for i, _ in own] == list(range(0, 3 * n, 3))
    parts = [p for _, p in own]
    assert parts == sorted(parts) and (n < 8 or len(set(parts)) > n // 4)
    first = {}
    for i, p in own:
        first.setdefault(p, i)
    order = sorted(first)
    want = sorted((first[b], a) for a, b in zip(order, order[1:])) + [(0, order[-1])]
    assert sorted((r.id, r.part) for r in rows if r.ahead) == sorted(want)
