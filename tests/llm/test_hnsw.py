"""Search against brute force: recall, exact scores, ties and the vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from billflow.llm import hnsw as H


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1)
                                  for i, v in vectors], "vec_id long, embedding array<float>, id string, shard int")


def exact(vectors, k):
    v = {i: np.array(x, np.float32).astype(float) for i, x in vectors}
    ids = np.array(sorted(v))
    e = np.array([v[i] for i in ids])
    out = {}
    for i in ids[ids % 20 == 0]:
        s = (e * v[i]).sum(1)
        s[ids == i] = -np.inf
        out[int(i)] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:min(k, len(ids) - 1)]]
    return out


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("spread", [0.0, 0.8])
def test_recall(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    v = centres[rng.integers(0, 30, 3000)] + 0.6 * rng.normal(size=(3000, 24))
    v = v / np.linalg.norm(v, axis=1)[:, None] * rng.lognormal(0, spread, size=(3000, 1))
    rows = list(enumerate(v.tolist()))
    got, want = found(H.nearest(table(spark, rows), F.col("id") % 20 == 0)), exact(rows, 20)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q in want:
        score = {i: s for i, s in got[q]}
        assert len(got[q]) == 20 and all(abs(score[i] - s) < 1e-9 for i, s in want[q] if i in score)
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))


def test_ties_and_hot_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 else rng.normal(size=8).tolist()) for i in range(400)]
    got, want = found(H.nearest(table(spark, rows), F.col("id") % 20 == 0)), exact(rows, 20)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_odd_rows(spark):
    good = [(0, [1, 0]), (20, [0, 1]), (3, [1, 1]), (3, [1, 1]), (40, [1, 2, 3]), (5, [2, 2, 2])]
    bad = [(60, None), (61, []), (80, [0, 0]), (81, [None, 1]), (100, [float("nan"), 1]), (101, [float("inf"), 1]),
           (None, [1, 1])]
    got = found(H.nearest(table(spark, good + bad), F.col("id") % 20 == 0))
    assert got == {0: [(3, 1.0), (20, 0.0)], 20: [(3, 1.0), (0, 0.0)], 40: [(5, 12.0)]}
    assert H.nearest(table(spark, []), F.col("id") % 20 == 0).count() == 0
    assert H.nearest(table(spark, [(0, [1, 2])]), F.col("id") % 20 == 0).count() == 0
