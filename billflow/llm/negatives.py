"""Hard negatives for anchors, by exact scores from Kronecker-packed products.

Components become integers, floor(``SCALE`` * x). A score is the integer inner product
with the anchor. Scores of several candidates come from one product: each component is
biased by its smallest value, so that it is not negative, and the candidates' components
are set into separate fields of one wide integer, ``width`` bits apart, where the largest
sum that can occur among these vectors fits. One multiplication per anchor component then
adds to all fields at once, no field runs over into the next, and the fields, unpacked and
rid of the bias, are the exact scores. The wide integer is a double while all fields fit
in its 53 bits, as integers below 2 ** 53 are exact there in any order of addition and a
matrix product does the work; larger components go into Python's integers of any width.

1. Usable rows are dealt by (length, label, hash) into groups of about ``ROWS``, sorted
   ranges, so that a label lies in few groups and a frequent one is spread over many. A
   group's rows are kept packed, with flags for the anchors among them.
2. Anchors travel to the groups in blocks, the groups stay: for positives to the groups
   that hold their labels, for negatives to all. A task holds one group and at most about
   ``LOT`` anchors (more go to further tasks) and scores them in tiles. It returns the best
   few per anchor, or per anchor and positive; these are merged by anchor.

Every anchor meets every row of a label of its own once, and every other row once: this
is the stated query set against all rows, in blocks, without a pair of rows in any table.

Defined results: rows with a null id, label or vector, or a null or non-finite component,
take no part; a vector meets only those of its own length (an empty vector scores 0);
rows equal in id, label and vector count once, and rows of the anchor's own id are neither
its positives nor its negatives; an anchor without positives, and a positive without
negatives, returns no row; a score beyond 64 bits stops the job; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, with_code

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
GROUPS, ROWS, BLOCK, LOT = 8, 32_768, 1024, 1 << 17
TILE_A, TILE_C = 256, 8192
NONE = -(2 ** 63) + 1
_EXACT = 1 << 53


def usable(v: Column) -> Column:
    inf = F.lit(float("inf"))
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as doubles, or as Python integers where doubles don't reach."""
    with np.errstate(over="ignore"):
        f = np.floor(x * SCALE)
    if np.isfinite(f).all() and (not f.size or np.abs(f).max() < _EXACT):
        return f
    num_den = np.frompyfunc(lambda v: (lambda p, q: p * SCALE // q)(*float(v).as_integer_ratio()), 1, 1)
    return num_den(x).reshape(x.shape)


class Packed:
    """Candidates in fields of wide integers, for products with any of the given anchors."""

    def __init__(self, c: np.ndarray, a_low: np.ndarray, a_high: np.ndarray):
        self.n, self.a_low = len(c), a_low
        self.c_low = c.min(axis=0)
        c = c - self.c_low
        ints = lambda x: [int(v) for v in x]
        a_most = [h - lo for lo, h in zip(ints(a_low), ints(a_high))]
        c_most = ints(c.max(axis=0))
        self.width = max(1, sum(p * q for p, q in zip(a_most, c_most)).bit_length())
        # what the bias adds to a score must be exact too
        extra = max(sum(abs(p) * q for p, q in zip(ints(a_low), c_most)),
                    sum(max(abs(p), abs(q)) * abs(r) for p, q, r in zip(ints(a_low), ints(a_high), ints(self.c_low))))
        self.narrow = c.dtype != object and a_low.dtype != object and self.width <= 53 and extra < _EXACT
        if not self.narrow:
            c = np.array([[int(v) for v in row] for row in c], object).reshape(c.shape)
        self.fields = 53 // self.width if self.narrow else max(1, 1024 // self.width)
        self.words = -(-self.n // self.fields)
        self.bias = c @ (a_low if self.narrow else np.array(ints(a_low), object)) if c.shape[1] else np.zeros(self.n)
        unit = float if self.narrow else int
        self.wide = np.zeros((self.words, c.shape[1]), c.dtype)
        for k in range(self.fields):
            some = c[k * self.words:(k + 1) * self.words]
            self.wide[:len(some)] += some * unit(1 << self.width * k)

    def scores(self, a: np.ndarray) -> np.ndarray:
        """(anchors, candidates): exact 64-bit scores."""
        if not self.narrow:
            a = np.array([[int(v) for v in row] for row in a], object).reshape(a.shape)
        low = self.a_low if self.narrow else np.array([int(v) for v in self.a_low], object)
        base = np.array([int(v) for v in self.c_low], object) if not self.narrow else self.c_low
        if not a.shape[1]:
            return np.zeros((len(a), self.n), np.int64)
        product = (a - low) @ self.wide.T
        own = a @ base
        if not self.narrow:
            mask = (1 << self.width) - 1
            field = np.concatenate([product >> self.width * k & mask for k in range(self.fields)], axis=1)[:, :self.n]
            s = field + self.bias[None, :] + own[:, None]
            if s.size and max(abs(int(s.min())), abs(int(s.max()))) >= -NONE:
                raise OverflowError("a score is beyond 64 bits")
            return s.astype(np.int64)
        product, mask = product.astype(np.int64), np.int64((1 << self.width) - 1)
        out = np.empty((len(a), self.n), np.int64)
        for k in range(self.fields):
            part = out[:, k * self.words:(k + 1) * self.words]
            np.right_shift(product[:, :part.shape[1]], self.width * k, out=part)
            part &= mask
        out += self.bias.astype(np.int64)[None, :]
        out += own.astype(np.int64)[:, None]
        return out


class Block:
    """Rows of one length: ids, labels and integer components."""

    def __init__(self, row):
        self.dim = int(row.dim)
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        x = np.frombuffer(row.parts, np.int16 if row.small else np.float64).reshape(len(self.ids), self.dim)
        self.v = x.astype(np.float64) if row.small else whole(x)


def _kept(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> dict:
    """How a block's rows are stored: 16-bit integers where they fit, else the vectors themselves."""
    f = whole(x)
    small = f.dtype != object and (not f.size or np.abs(f).max() < 1 << 15)
    return {"dim": x.shape[1], "n": len(ids), "ids": ids.astype(np.int64).tobytes(), "labels": labels.astype(np.int64).tobytes(),
            "small": small, "parts": (f.astype(np.int16) if small else x).tobytes(), "kinds": np.unique(labels).tolist()}


_BLOCK = "dim int, n int, ids binary, labels binary, small boolean, parts binary, kinds array<bigint>"
_TYPES = {"group": pa.int32(), "block": pa.int64(), "dim": pa.int32(), "n": pa.int32(), "ids": pa.binary(), "labels": pa.binary(),
          "small": pa.bool_(), "parts": pa.binary(), "kinds": pa.list_(pa.int64()), "anchors": pa.binary()}


def _row(values: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values[c]], t) for c, t in _TYPES.items() if c in values],
                                      names=[c for c in _TYPES if c in values])


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, id, label, v, anchor), sorted by length, into one block per ROWS rows of a length."""
    from pyspark import TaskContext

    group, held, size, dim = TaskContext.get().partitionId(), [], 0, None

    def flush() -> pa.RecordBatch:
        ids, labels, flags, flat = (np.concatenate([h[i] for h in held]) for i in range(4))
        return _row({"group": group, **_kept(ids, labels, flat.reshape(len(ids), dim)),
                     "anchors": flags.astype(np.uint8).tobytes()})

    for b in batches:
        dims = b.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
        for lo, hi in zip(edges, edges[1:]):
            if hi == lo:
                continue
            if held and (dim != dims[lo] or size >= ROWS):
                yield flush()
                held, size = [], 0
            dim, size = int(dims[lo]), size + hi - lo
            vectors = b.column(3).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
            held.append((b.column(1).slice(lo, hi - lo).to_numpy(), b.column(2).slice(lo, hi - lo).to_numpy(),
                         b.column(4).slice(lo, hi - lo).to_numpy(zero_copy_only=False), vectors))
    if held:
        yield flush()


def build_groups(df: DataFrame, is_anchor: Column, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Usable rows, packed: group, the block's columns, flags of its anchors."""
    i, lab, v = F.col(id_col), F.col(label_col), F.col(vec_col)
    rows = (df.filter(i.isNotNull() & lab.isNotNull() & usable(v))
            .select(i.cast("long").alias("id"), lab.cast("long").alias("label"), v.cast("array<double>").alias("v"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor")).dropDuplicates())
    rows = cut(rows)
    groups = max(GROUPS, -(-rows.count() // ROWS))
    order = [F.size("v"), F.col("label"), F.xxhash64("id", "v")]
    dealt = rows.repartitionByRange(groups, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.size("v").alias("dim"), "id", "label", "v", "anchor")
    return cut(with_code(dealt).mapInArrow(_store, f"group int, {_BLOCK}, anchors binary"))


def _anchor_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for b in batches:
        for row in b.to_pandas().itertuples():
            flags = np.frombuffer(row.anchors, np.uint8).astype(bool)
            ids, labels = np.frombuffer(row.ids, np.int64)[flags], np.frombuffer(row.labels, np.int64)[flags]
            x = np.frombuffer(row.parts, np.int16 if row.small else np.float64).reshape(row.n, row.dim)[flags]
            for lo in range(0, len(ids), BLOCK):
                part = slice(lo, lo + BLOCK)
                yield _row({"block": number, "dim": row.dim, "n": len(ids[part]), "ids": ids[part].tobytes(),
                            "labels": labels[part].tobytes(), "small": row.small, "parts": x[part].tobytes(),
                            "kinds": np.unique(labels[part]).tolist()})
                number += 1


class Best:
    """The best few candidates of each of some searches, by score, then smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.ids = k, np.full((n, k), NONE, np.int64), np.zeros((n, k), np.int64)

    def offer(self, at: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the searches ``at[row]``, sorted by row, then best first."""
        if not len(row):
            return
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        few = rank < self.k
        s, i = np.full((len(at), self.k), NONE, np.int64), np.zeros((len(at), self.k), np.int64)
        s[row[few], rank[few]], i[row[few], rank[few]] = score[few], ids[few]
        s, i = np.concatenate([self.score[at], s], axis=1), np.concatenate([self.ids[at], i], axis=1)
        order = np.lexsort((i, -s), axis=-1)[:, :self.k]
        self.score[at], self.ids[at] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _tiles(anchors: Block, group: Block, rows: np.ndarray, columns: np.ndarray):
    """Scores of the given anchors and candidates, tile by tile: (anchor rows, candidate rows, scores)."""
    if not len(rows) or not len(columns):
        return
    a = anchors.v[rows]
    low, high = a.min(axis=0), a.max(axis=0)
    for c in range(0, len(columns), TILE_C):
        some = columns[c:c + TILE_C]
        packed = Packed(group.v[some], low, high)
        for r in range(0, len(rows), TILE_A):
            yield rows[r:r + TILE_A], some, packed.scores(a[r:r + TILE_A])


def _sorted(ok: np.ndarray, s: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, score and id where ``ok``, by row, then best first."""
    r, c = np.nonzero(ok)
    v, i = s[r, c], ids[c]
    order = np.lexsort((i, -v, r))
    return r[order], v[order], i[order]


def best_positives(anchors: Block, group: Block, k: int = POSITIVES) -> Best:
    best = Best(len(anchors.ids), k)
    for label in np.intersect1d(anchors.labels, group.labels):
        for at, cand, s in _tiles(anchors, group, np.flatnonzero(anchors.labels == label), np.flatnonzero(group.labels == label)):
            ids = group.ids[cand]
            s[ids[None, :] == anchors.ids[at][:, None]] = NONE
            least = best.score[at][:, -1]  # below the worst kept none gets in
            if s.shape[1] > k:
                least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, -k])
            best.offer(at, *_sorted((s >= least[:, None]) & (s > NONE), s, ids))
    return best


def bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score s with low * p <= 100 * s <= high * p; (1, 0) where there is no positive."""
    some = [(-(-low * p // 100), high * p // 100) if p != NONE else (1, 0) for p in positive.ravel().tolist()]
    both = np.clip(np.array(some, object).reshape(-1, 2), NONE + 1, -NONE).astype(np.int64)
    return both[:, 0].reshape(positive.shape), both[:, 1].reshape(positive.shape)


def best_negatives(anchors: Block, positive: np.ndarray, group: Block, k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> Best:
    """One search per anchor and positive (anchor-major); ``positive`` (anchors, positives) holds scores, NONE for none."""
    p = positive.shape[1]
    best = Best(positive.size, k)
    lo, hi = bounds(positive, low, high)
    has = (lo <= hi).any(axis=1)
    for label in np.unique(anchors.labels):
        for at, cand, s in _tiles(anchors, group, np.flatnonzero((anchors.labels == label) & has),
                                  np.flatnonzero(group.labels != label)):
            ids = group.ids[cand]
            worst = best.score.reshape(-1, p, k)[at][:, :, -1]
            l, h = np.where(lo[at] <= hi[at], np.maximum(lo[at], worst), -NONE), np.where(lo[at] <= hi[at], hi[at], NONE)
            r, v, i = _sorted((s >= l.min(axis=1)[:, None]) & (s <= h.max(axis=1)[:, None])
                              & (ids[None, :] != anchors.ids[at][:, None]), s, ids)
            for j in range(p):
                ok = (v >= l[r, j]) & (v <= h[r, j])
                best.offer(at * p + j, r[ok], v[ok], i[ok])
    return best


def _found(columns: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for c, x in columns.items()})


def _scan(found: list[str], one: Callable) -> Callable:
    """A cogrouped function: ``one(anchor row, its block, group block)`` gives columns, for each two of one length."""

    def run(asked: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c: [] for c in found}
        for g in groups.itertuples():
            group = Block(g)
            for a in asked.itertuples():
                if a.dim == g.dim:
                    for c, x in zip(found, one(a, Block(a), group)):
                        out[c].append(x)
        return _found(out)

    return run


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Positives: the first ``positives`` other rows of the anchor's label. Negatives of each:
    the first ``negatives`` rows of another label whose score is ``low`` to ``high`` percent
    of the positive's. Higher scores come first, ties by smaller id.
    """
    groups = build_groups(df, is_anchor, id_col, vec_col, label_col)
    blocks = cut(with_code(groups).mapInArrow(_anchor_blocks, f"block bigint, {_BLOCK}"))
    n_anchors, n_groups = blocks.agg(F.sum("n")).first()[0] or 0, (groups.agg(F.max("group")).first()[0] or 0) + 1
    lots = max(1, -(-n_anchors // LOT))
    lot = F.pmod(F.xxhash64("block"), F.lit(lots)).cast("int")
    right = groups.select(F.col("group").alias("in_group"), *[c.split()[0] for c in _BLOCK.split(", ")],
                          F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("in_lot"))

    kinds = blocks.select("block", "dim", F.explode("kinds").alias("kind"))
    need = (kinds.join(groups.select("group", "dim", F.explode("kinds").alias("kind")).distinct(), ["dim", "kind"])
            .select("block", "group").distinct())

    def own_label(a, anchors, group):
        best = best_positives(anchors, group, positives)
        r, c = np.nonzero(best.score > NONE)
        return np.full(len(r), a.block), r, best.ids[r, c], best.score[r, c]

    near = (blocks.join(need, "block").withColumn("lot", lot).groupBy("group", "lot")
            .cogroup(right.groupBy("in_group", "in_lot"))
            .applyInPandas(_scan(["block", "at", "id", "score"], own_label), "block bigint, at bigint, id bigint, score bigint"))
    first = Window.partitionBy("block", "at").orderBy(F.desc("score"), "id")
    chosen = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)

    def with_positives(b: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(b) or not len(p):
            return pd.DataFrame(columns=[*b.columns, "pos_ids", "pos_scores"])
        ids, scores = np.zeros((b.n.iloc[0], positives), np.int64), np.full((b.n.iloc[0], positives), NONE, np.int64)
        ids[p["at"], p["place"] - 1], scores[p["at"], p["place"] - 1] = p["id"], p["score"]
        return b.assign(pos_ids=[ids.tobytes()], pos_scores=[scores.tobytes()])

    asked = cut(blocks.groupBy("block").cogroup(chosen.groupBy("block")).applyInPandas(
        with_positives, f"block bigint, {_BLOCK}, pos_ids binary, pos_scores binary"))

    found = ["block", "at", "place", "anchor_id", "positive_id", "positive_score", "id", "score"]

    def other_labels(a, anchors, group):
        ids, scores = (np.frombuffer(x, np.int64).reshape(-1, positives) for x in (a.pos_ids, a.pos_scores))
        best = best_negatives(anchors, scores, group, negatives, low, high)
        r, c = np.nonzero(best.score > NONE)
        at, j = r // positives, r % positives
        return np.full(len(r), a.block), at, j, anchors.ids[at], ids[at, j], scores[at, j], best.ids[r, c], best.score[r, c]

    hard = (asked.withColumn("lot", lot).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
            .groupBy("group", "lot").cogroup(right.groupBy("in_group", "in_lot"))
            .applyInPandas(_scan(found, other_labels), ", ".join(f"{c} bigint" for c in found)))
    order = Window.partitionBy("block", "at", "place").orderBy(F.desc("score"), "id")
    return (hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
