"""Near duplicates against all pairs; signatures against the Jaccard similarity they estimate."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from billflow.llm import minhash as M

from .conftest import by_id, documents


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent=80):
    sets = {d: shingles(t, k) for d, t, _ in rows}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


def corpus(seed=1, n=240):
    """Copies, chains of near copies, hubs whose spokes are far from each other, words edited anywhere."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = []
    while len(texts) < n:
        w = [word() for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 20, 60, 150]))]
        texts.append(" ".join(w))
        kind = rng.random()
        if kind < 0.15:
            texts += [texts[-1].upper()] * rng.randint(1, 4)
        elif kind < 0.35 and len(w) > 15:
            for _ in range(rng.randint(1, 5)):  # a chain
                w = list(w)
                w[rng.randrange(len(w))] = word()
                texts.append(" ".join(w))
        elif kind < 0.5 and len(w) > 15:
            for _ in range(8):  # a hub: each spoke differs elsewhere
                x = list(w)
                for _ in range(max(1, len(w) // 45)):
                    x[rng.randrange(len(x))] = word()
                texts.append("\t".join(x))
    rng.shuffle(texts)
    return [(i * 2 + 1, t, "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,seed", [(4, 1), (5, 2)])
def test_matches_all_pairs(spark, k, seed):
    rows = corpus(seed)
    got = by_id(M.near_duplicates(documents(spark, rows).repartition(5), shingle=k))
    for d, (n, top) in brute(rows, k).items():
        r, = got[d]
        assert (r.n_shingles, r.component_id, r.kept) == (n, top, d == top)


def test_signatures():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2 ** 63, 60_000).astype(np.uint64))
    rng.shuffle(pool)
    for size, share in ((10, 0.8), (100, 0.5), (4000, 0.9), (4000, 0.2)):
        n = round(2 * size * share / (1 + share))
        a, b = pool[:size], np.concatenate([pool[:n], pool[size:2 * size - n]])
        s = M.super_minhash([a, b, a[::-1]], 200)
        assert np.isfinite(s).all() and (s[0] == s[2]).all()
        assert abs((s[0] == s[1]).mean() - n / (2 * size - n)) < 0.15
    one = M.super_minhash([pool[:1]], 64)  # a single element fills every slot at its own level
    assert sorted(np.floor(one[0]).tolist()) == list(range(64))


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.node: r.root for r in M.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    assert got == {x: r for x, r in root.items() if any(a != b and x in (a, b) for a, b in edges)}


def test_odd_rows(messy, empty):
    got = by_id(M.near_duplicates(messy, shingle=4))
    assert got[2][0].n_shingles == 0 and got[2][0].kept and got[6][0].n_shingles == 0
    assert got[8][0].component_id == 7 and not got[8][0].kept
    assert got[5][0].component_id == 4 and len(got[1]) == 2
    assert M.near_duplicates(empty).count() == 0
    left = M.drop_near_duplicates(messy)
    assert left.columns == messy.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 2, 3, 4, 6, 7, 9, 10]
    assert M.drop_near_duplicates(empty).count() == 0


def test_unlike_texts_under_one_id(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, one, "s"), (2, one, "s"), (2, two, "s"), (3, three, "s"), (3, one, "s"), (3, three, "s"), (4, two + " x", "s"),
            (None, three, "s"), (None, two + " y z", "t"), (None, "own words of no id at all", "s"),
            (None, "own words of no id at all", "t"), (None, "", "s"), (None, "", "t"), (None, None, "s"), (5, None, "s"), (5, "", "s")]
    df = documents(spark, rows)
    left = M.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [
        (0, ""), (0, ""), (0, ""), (0, "own words of no id at all"), (1, one), (2, two), (3, three), (5, "")]
