"""Nearest neighbours by inner product: one small-world graph per shard, merged.

Vectors are dealt to shards by a hash of their id (``ROWS`` at most on average,
``SHARDS`` shards at least). Each shard builds a hierarchical navigable small
world over its distinct vectors: nodes get a level from a hash, are inserted in
batches, linked to diverse near nodes on each of their levels, and linked back.
The graph is stored as flat neighbour arrays, one row per shard. Queries come in
blocks; every (shard, block) is one bounded task that walks the graph for all
queries of the block in lockstep. Finds are scored exactly, in double precision,
on the original vectors, and the shards' finds of a query are merged.

Inner product is no distance; a shard's vectors get one more component,
sqrt(largest norm squared - norm squared), which makes the nearest by distance
the largest by inner product.

Equal vectors are one node that keeps its ``k`` + 1 smallest ids: by the tie rule
no query can return more of them. Their ids are dealt to all shards alike, so a
vector that a third of the rows share makes no shard larger than others.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do null ids; vectors meet only those of their own
length; repeated rows of one id and vector count
once, an id with several vectors counts with its best; a query with fewer than
``k`` candidates returns them all; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix64, with_code

SHARDS, ROWS, QUERY_BLOCK = 8, 32_768, 2048
M, EF_BUILD, EF_SEARCH, WIDE = 16, 64, 128, 4
LOCKSTEP = 256


def usable(v: Column) -> Column:
    """Neither null nor zero, all components finite."""
    inf = F.lit(float("inf"))
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
            & F.exists(v, lambda x: x != 0))


def _sq(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of a (..., i, d) to b (..., j, d)."""
    d = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * (a @ np.swapaxes(b, -1, -2))
    return np.maximum(d, 0)


def walk(vec: np.ndarray, nbr: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walk for all rows of ``q`` at once; (nodes, squared distances), nearest first, -1 padded.

    ``nbr`` (n, degree) holds neighbours, -1 for none; ``entry`` (rows, e) holds start nodes.
    """
    n, rows = len(vec), len(q)
    mark = np.full((rows, n + 1), -1, np.int32)  # the last column takes what is no node
    mark[:, n] = 0
    norm = (vec * vec).sum(1)
    qn = (q * q).sum(1)
    nodes = np.full((rows, ef), -1, np.int64)
    dist = np.full((rows, ef), np.inf, np.float32)
    open_ = np.zeros((rows, ef), bool)

    def offer(at: np.ndarray, cand: np.ndarray) -> None:
        cand = np.where(cand < 0, n, cand)
        r = at[:, None]
        fresh = mark[r, cand] < 0
        tag = np.arange(cand.shape[1], dtype=np.int32)[None, :]
        mark[r, np.where(fresh, cand, n)] = np.broadcast_to(tag, cand.shape)
        fresh &= mark[r, cand] == tag  # of repeats within the row one stays
        mark[at, n] = 0
        safe = np.where(fresh, cand, 0)
        d = norm[safe] + qn[at][:, None] - 2 * np.einsum("rcd,rd->rc", vec[safe], q[at])
        d = np.where(fresh, np.maximum(d, 0), np.inf).astype(np.float32)
        all_d = np.concatenate([dist[at], d], axis=1)
        pick = np.argpartition(all_d, ef - 1, axis=1)[:, :ef]
        pick = np.take_along_axis(pick, np.argsort(np.take_along_axis(all_d, pick, 1), axis=1, kind="stable"), 1)
        dist[at] = np.take_along_axis(all_d, pick, 1)
        nodes[at] = np.take_along_axis(np.concatenate([nodes[at], np.where(fresh, cand, -1)], axis=1), pick, 1)
        open_[at] = np.take_along_axis(np.concatenate([open_[at], fresh], axis=1), pick, 1)

    offer(np.arange(rows), entry)
    while True:
        at = np.flatnonzero(open_.any(axis=1))
        if not len(at):
            return nodes, dist
        first = np.argsort(~open_[at], axis=1, kind="stable")[:, :WIDE]  # the nearest not yet expanded
        use = np.take_along_axis(open_[at], first, 1)
        go = np.where(use, np.take_along_axis(nodes[at], first, 1), -1)
        open_[at[:, None], first] = False
        step = np.where(go[:, :, None] >= 0, nbr[np.maximum(go, 0)], -1)
        offer(at, step.reshape(len(at), -1))


def diverse(vec: np.ndarray, base: np.ndarray, cand: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 padded) the ones nearer to it than to any chosen one; then the rest."""
    rows, c = cand.shape
    v = vec[np.maximum(cand, 0)]
    among = _sq(v, v)
    ok = cand >= 0
    chosen = np.zeros((rows, c), bool)
    near = np.full((rows, c), np.inf, np.float32)  # distance of each candidate to the chosen ones
    for j in range(c):
        take = ok[:, j] & (dist[:, j] < near[:, j]) & (chosen.sum(1) < most)
        chosen[:, j] = take
        near[take] = np.minimum(near[take], among[take, j])
    order = np.argsort(np.where(ok, np.where(chosen, 0, 1), 2), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(np.where(ok, cand, -1), order, 1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _link(vec: np.ndarray, nbr: np.ndarray, new: np.ndarray, links: np.ndarray) -> None:
    """Set the links of ``new`` nodes and link back, pruning lists that grow over their size."""
    most = nbr.shape[1]
    nbr[new, :links.shape[1]] = links
    src = np.repeat(new, links.shape[1])
    dst = links.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    if not len(dst):
        return
    d = ((vec[src] - vec[dst]) ** 2).sum(1)
    order = np.lexsort((d, dst))
    src, dst = src[order], dst[order]
    to, start, count = np.unique(dst, return_index=True, return_counts=True)
    rank = np.arange(len(dst)) - np.repeat(start, count)
    fits = rank < most
    add = np.full((len(to), most), -1, np.int64)
    add[np.repeat(np.arange(len(to)), count)[fits], rank[fits]] = src[fits]
    both = np.concatenate([nbr[to], add], axis=1)
    full = (both >= 0).sum(1) > most
    easy = both[~full]
    nbr[to[~full]] = np.take_along_axis(easy, np.argsort(easy < 0, axis=1, kind="stable"), 1)[:, :most]
    for lo in range(0, int(full.sum()), 1024):
        t, b = to[full][lo:lo + 1024], both[full][lo:lo + 1024]
        place = np.arange(b.shape[1])
        again = ((b[:, :, None] == b[:, None, :]) & (place[:, None] > place)).any(2)  # linked both ways already
        b = np.where(again, -1, b)
        dd = np.where(b >= 0, ((vec[np.maximum(b, 0)] - vec[t][:, None, :]) ** 2).sum(2), np.inf).astype(np.float32)
        o = np.argsort(dd, axis=1, kind="stable")
        nbr[t] = diverse(vec, t, np.take_along_axis(b, o, 1), np.take_along_axis(dd, o, 1), most)


class Graph:
    """Levels of flat neighbour arrays over float32 vectors; level 0 holds all nodes."""

    def __init__(self, vec: np.ndarray, nbrs: list[np.ndarray], nodes: list[np.ndarray]):
        self.vec, self.nbrs, self.nodes = vec, nbrs, nodes

    @classmethod
    def build(cls, vec: np.ndarray, seed: int = 7) -> "Graph":
        n = len(vec)
        u = ((mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) >> np.uint64(11)).astype(float)
             + 0.5) * 2.0 ** -53
        level = np.floor(-np.log(u) / np.log(M)).astype(int)
        order = np.argsort(-level, kind="stable")  # highest first: upper levels are there before lower ones need them
        vec, level = vec[order], level[order]
        # nodes of a level are a prefix; a node has one number on all levels
        sizes = [int((level >= k).sum()) for k in range(int(level.max()) + 1 if n else 1)]
        while len(sizes) > 1 and sizes[-1] < 2:
            sizes.pop()
        nbrs = [np.full((s, 2 * M if k == 0 else M), -1, np.int64) for k, s in enumerate(sizes)]
        g = cls(vec, nbrs, sizes)
        for k in range(len(sizes) - 1, -1, -1):
            done = 0
            while done < sizes[k]:
                size = min(sizes[k] - done, max(32, min(done, 1024)))
                new = np.arange(done, done + size)
                own = _sq(vec[new], vec[new]).astype(np.float32)
                own[np.arange(size), np.arange(size)] = np.inf
                near = np.argsort(own, axis=1, kind="stable")[:, :EF_BUILD]
                cand, dist = near + done, np.take_along_axis(own, near, 1)
                cand = np.where(np.isinf(dist), -1, cand)
                if done:
                    found = [g._find(vec[new[lo:lo + LOCKSTEP]], EF_BUILD, k, done) for lo in range(0, size, LOCKSTEP)]
                    cand = np.concatenate([cand, np.concatenate([f[0] for f in found])], axis=1)
                    dist = np.concatenate([dist, np.concatenate([f[1] for f in found])], axis=1)
                o = np.argsort(dist, axis=1, kind="stable")[:, :EF_BUILD]
                cand, dist = np.take_along_axis(cand, o, 1), np.take_along_axis(dist, o, 1)
                links = np.concatenate([diverse(vec, new[lo:lo + LOCKSTEP], cand[lo:lo + LOCKSTEP],
                                                dist[lo:lo + LOCKSTEP], M) for lo in range(0, size, LOCKSTEP)])
                _link(vec, nbrs[k], new, links)
                done += size
        g.order = order
        return g

    def _find(self, q: np.ndarray, ef: int, level: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The walk on ``level`` among its first ``limit`` nodes, entered through the levels above."""
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(len(self.nbrs) - 1, level, -1):
            entry, _ = walk(self.vec[:len(self.nbrs[k])], self.nbrs[k], q, entry, 8)
        entry = np.where(entry < limit, entry, -1)
        entry[(entry < 0).all(axis=1), 0] = 0
        return walk(self.vec[:limit], self.nbrs[level][:limit], q, entry, ef)

    def find(self, q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
        """For each row of ``q`` the nodes met nearest, -1 padded."""
        out = [self._find(q[lo:lo + LOCKSTEP], ef, 0, len(self.vec))[0] for lo in range(0, len(q), LOCKSTEP)]
        return np.concatenate(out) if out else np.empty((0, ef), np.int64)


def lifted(v: np.ndarray) -> np.ndarray:
    """Vectors with the component that turns inner product into distance."""
    v = v.astype(np.float64)
    sq = (v * v).sum(1)
    top = sq.max() if len(sq) else 1.0
    scale = 1 / np.sqrt(top) if top > 0 else 1.0
    return np.column_stack([v * scale, np.sqrt(np.maximum(0, 1 - sq * scale * scale))]).astype(np.float32)


def _build_shard(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    v = np.array(pdf["v"].tolist(), dtype=np.float64)
    ids = pdf["id"].to_numpy(np.int64)
    distinct, which = np.unique(v, axis=0, return_inverse=True)
    which = which.ravel()
    o = np.lexsort((ids, which))
    o = o[np.concatenate([[True], (np.diff(which[o]) != 0) | (np.diff(ids[o]) != 0)])]  # repeated rows once
    start = np.searchsorted(which[o], np.arange(len(distinct)))
    rank = np.arange(len(o)) - start[which[o]]
    keep = o[rank <= k]
    g = Graph.build(lifted(distinct))
    back = np.empty(len(distinct), np.int64)
    back[g.order] = np.arange(len(distinct))
    node = back[which[keep]]
    o = np.lexsort((ids[keep], node))
    return pd.DataFrame([{
        "dim": int(v.shape[1]), "shard": int(pdf["shard"].iloc[0]), "n": len(distinct),
        "vectors": distinct[g.order].tobytes(), "sizes": [len(x) for x in g.nbrs],
        "links": np.concatenate([x.ravel() for x in g.nbrs]).astype(np.int32).tobytes(),
        "member_node": node[o].astype(np.int32).tobytes(), "member_id": ids[keep][o].tobytes()}])


def _search_block(queries: pd.DataFrame, index: pd.DataFrame, k: int, ef: int) -> pd.DataFrame:
    empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
    if not len(queries) or not len(index):
        return empty
    row = index.iloc[0]
    v = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
    flat, nbrs, at = np.frombuffer(row["links"], np.int32), [], 0
    for level, s in enumerate(row["sizes"]):
        wide = 2 * M if level == 0 else M
        nbrs.append(flat[at:at + s * wide].reshape(s, wide).astype(np.int64))
        at += s * wide
    g = Graph(lifted(v), nbrs, list(row["sizes"]))
    node, member = np.frombuffer(row["member_node"], np.int32), np.frombuffer(row["member_id"], np.int64)
    first = np.searchsorted(node, np.arange(row["n"] + 1))
    q = np.array(queries["v"].tolist(), dtype=np.float64)
    qid = queries["id"].to_numpy(np.int64)
    asked = np.column_stack([q / np.maximum(np.linalg.norm(q, axis=1), 1e-300)[:, None], np.zeros(len(q))])
    out = []
    nodes = g.find(asked.astype(np.float32), max(ef, k + 1))
    for i in range(len(q)):
        near = nodes[i][nodes[i] >= 0]
        score = (v[near] * q[i]).sum(axis=1)
        o = np.argsort(-score, kind="stable")[:2 * k + 2]
        # a (k + 1)-th best node can only tie; members of one node share its score
        near, score = near[o], score[o]
        count = first[near + 1] - first[near]
        of = np.repeat(np.arange(len(near)), count)
        ids = np.concatenate([member[first[x]:first[x + 1]] for x in near]) if len(near) else np.empty(0, np.int64)
        s = score[of]
        other = ids != qid[i]
        ids, s = ids[other], s[other]
        best = np.lexsort((ids, -s))[:k]
        out.append(pd.DataFrame({"query_id": qid[i], "vec_id": ids[best], "score": s[best]}))
    return pd.concat(out, ignore_index=True) if out else empty


def build_index(df: DataFrame, id_col: str, vec_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(usable vectors: id, v, dim; index: one row per shard and length)."""
    good = (df.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .withColumn("dim", F.size("v")))
    shards = max(SHARDS, -(-good.count() // ROWS))
    dealt = good.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    index = with_code(dealt).groupBy("dim", "shard").applyInPandas(
        lambda pdf: _build_shard(pdf, k),
        "dim int, shard int, n int, vectors binary, sizes array<int>, links binary, member_node binary, member_id binary")
    return good, cut(index)


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            ef: int = EF_SEARCH) -> DataFrame:
    """For each query row its ``k`` nearest other rows: query_id, rank (from 1), vec_id, score."""
    good, index = build_index(df, id_col, vec_col, k)
    asked = good.filter(is_query).dropDuplicates(["id", "v"])
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int"))
    places = index.select(F.col("dim").alias("in_dim"), F.col("shard").alias("in_shard"))  # one small row per shard
    left = asked.join(F.broadcast(places), F.col("dim") == F.col("in_dim")).select("in_dim", "in_shard", "block", "id", "v")
    right = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("for_block"))
    found = left.groupBy("in_dim", "in_shard", "block").cogroup(right.groupBy("dim", "shard", "for_block")).applyInPandas(
        lambda a, b: _search_block(a, b, k, ef), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
