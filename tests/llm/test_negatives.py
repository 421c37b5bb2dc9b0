"""Hard negatives against brute force; packed products against Python's integers."""

from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from billflow.llm import negatives as N

SCHEMA = "vec_id long, label int, embedding array<float>, id string, v int, block int, score string, dim int, at int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "s", 3, 4) for r in rows], SCHEMA)


def brute(rows, anchor=lambda i: i % 50 == 0, positives=5, negatives=3, low=50, high=95):
    good = {(i, lab, tuple(v)) for i, lab, v in rows if None not in (i, lab, v) and all(
        x is not None and np.isfinite(x) for x in v)}
    good = [(i, lab, [floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in good]
    out = []
    for i, lab, v in good:
        if not anchor(i):
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i and len(w) == len(v)]
        for p, pid, _ in sorted(x[:2] + (0,) for x in score if x[2] == lab)[:positives]:
            ok = sorted((s, j) for s, j, other in score if other != lab and low * -p <= 100 * -s <= high * -p)
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j) in enumerate(ok[:negatives])]
    return sorted(out)


def mined(df, **kw):
    got = N.mine(df, F.col("vec_id") % 50 == 0, **kw)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(n, d, seed, centres=4):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    v = c[rng.integers(0, centres, n)] + 0.4 * rng.normal(size=(n, d))
    return (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32).tolist()


@pytest.mark.parametrize("a_size,c_size,kind", [(0.3, 0.3, "narrow"), (20, 20, "narrow"), (1e4, 1e3, "narrow"), (3e5, 3e5, "wide")])
def test_products_are_exact(a_size, c_size, kind):
    rng = np.random.default_rng(1)
    a, c = N.whole(rng.normal(size=(7, 33)) * a_size), N.whole(rng.normal(size=(101, 33)) * c_size)
    p = N.Packed(c, a.min(axis=0), a.max(axis=0))
    assert p.narrow == (kind == "narrow")
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in c] for r in a]
    assert p.scores(a).tolist() == want


def test_several_fields_a_word():
    a = N.whole(np.array(vectors(50, 64, 2)))
    p = N.Packed(a, a.min(axis=0), a.max(axis=0))
    assert p.narrow and p.fields >= 2 and p.words == 25


def test_fields_at_their_limits():
    a, c = np.array([[255.0, -256.0]] * 2), np.array([[255.0, -256.0], [-256.0, 255.0], [0.0, 0.0]])
    p = N.Packed(c, np.array([-256.0, -256.0]), np.array([255.0, 255.0]))
    assert p.scores(a).tolist() == (a @ c.T).astype(int).tolist()


def test_components_beyond_doubles():
    assert N.whole(np.array([[1e306, -0.001]])).tolist() == [[int(1e306) * 256, -1]]
    big = N.whole(np.array([[1e300]]))
    with pytest.raises(OverflowError):
        N.Packed(big, big[0], big[0]).scores(big)


@pytest.mark.parametrize("seed,n,labels", [(0, 400, 10), (1, 600, 2), (2, 300, 250)])
def test_matches_brute_force(spark, seed, n, labels):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(rng.integers(0, labels)), v) for i, v in enumerate(vectors(n, 12, seed))]
    want = brute(rows)
    assert mined(table(spark, rows)) == want
    assert want or labels == 250


def test_small_blocks_lots_and_tiles(spark, monkeypatch):
    for name, value in {"ROWS": 40, "BLOCK": 3, "LOT": 4, "TILE_C": 16, "TILE_A": 2}.items():
        monkeypatch.setattr(N, name, value)
    rows = [(i, i % 3, v) for i, v in enumerate(vectors(500, 8, 5))]
    assert mined(table(spark, rows)) == brute(rows)


def test_ties_copies_and_repeats(spark):
    """A vector that a third of the rows share, scores that tie, rows repeated whole and ids with two vectors."""
    v = vectors(300, 6, 9, centres=2)
    rows = [(i, i % 4, v[0] if i % 3 == 0 else v[i]) for i in range(300)]
    rows += rows[:40] + [(100, 0, v[7]), (100, 1, v[8]), (3, 2, v[0])]
    assert mined(table(spark, rows)) == brute(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 2, v) for i, v in enumerate(vectors(120, 4, 3))]
    rows += [(150, None, [1.0] * 4), (200, 1, None), (250, 1, [1.0, None, 0.0, 0.0]), (300, 0, [nan, 1.0, 1.0, 1.0]),
             (350, 0, [inf, 1.0, 1.0, 1.0]), (None, 0, [0.5] * 4), (400, 0, []), (450, 0, []), (451, 1, []),
             (500, 0, [0.1, 0.2]), (501, 0, [0.1, 0.3]), (502, 1, [0.1, 0.2]), (550, 7, [0.5] * 4), (600, 0, [0.0] * 4)]
    got = mined(table(spark, rows))
    assert got == brute(rows)
    assert (400, 450, 1, 451, 0, 0) in got and not [r for r in got if r[0] == 550]


def test_large_components(spark):
    rows = [(i, i % 3, [x * 3e5 for x in v]) for i, v in enumerate(vectors(160, 5, 4))]
    assert mined(table(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(1, 1, [1.0]), (2, 1, [1.0])])) == []
