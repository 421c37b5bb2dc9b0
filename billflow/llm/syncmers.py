"""Document fingerprints from closed syncmers.

A k-mer (k code points) is a closed syncmer when the smallest hash among its
inner s-mers sits at its first or last place (leftmost on ties). Whether it is
one depends on its own characters alone, so an edit moves only the anchors that
touch it: equal stretches of two texts have equal anchors, wherever they stand.

``anchors`` gives (position, hash) lists for positional matching; ``fingerprint``
keeps the smallest distinct anchor hashes, a bottom-k sketch whose likeness
estimates the Jaccard similarity of the anchor sets. A text without any anchor
(shorter than k, or of a few k-mers none of which qualifies) is one anchor as a
whole, at position 0.

Defined results: a null text counts as empty, and an empty text has the empty
fingerprint; two empty fingerprints are alike (1.0), an empty and another are
not (0.0); repeated rows each get a result; equal texts have equal fingerprints.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix64, sha, with_code

K, S, KEEP = 20, 13, 128
_U = np.uint64
_B = _U(0x9E3779B97F4A7C15)


def _rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of every n codes in a row, built by doubling."""
    have, size, power = codes.astype(_U) + _U(1), 1, int(_B)  # have covers size codes; power is B ** size
    out, done = None, 0  # out covers done codes
    while size <= n:
        if n & size:
            if out is None:
                out = have
            else:
                m = max(0, min(len(out), len(have) - done))
                out = out[:m] * _U(power) + have[done:done + m]
            done += size
        m = max(0, len(have) - size)
        have = have[:m] * _U(power) + have[size:size + m]
        size, power = size * 2, power * power & 0xFFFFFFFFFFFFFFFF
    return out


def syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of one array of code points."""
    if len(codes) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    inner = mix64(_rolled(codes, s))
    w = k - s + 1
    n = len(codes) - k + 1
    # smallest of every w inner hashes: widen by doubling, then overlap two
    low, width = inner, 1
    while width * 2 <= w:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < w:
        low = np.minimum(low[:n], low[w - width:w - width + n])
    low = low[:n]
    at = np.flatnonzero((inner[:n] == low) | (inner[w - 1:w - 1 + n] == low))
    if not len(at):
        return at, np.empty(0, np.uint32)
    # a k-mer from its inner hashes: first and last overlap and cover it
    return at, (mix64(inner[at] * _B + inner[at + w - 1]) >> _U(32)).astype(np.uint32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _whole(codes: np.ndarray) -> np.ndarray:
    if not len(codes):
        return np.empty(0, np.uint32)
    place = np.arange(len(codes), dtype=_U)
    return np.array([mix64(np.array([np.sum(mix64(codes.astype(_U) + (place << _U(32))), dtype=_U)]))[0] >> _U(32)],
                    np.uint32)


def anchors_of(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    codes = _codes(text)
    at, h = syncmers(codes, k, s)
    if not len(at):
        h = _whole(codes)
        at = np.zeros(len(h), np.int64)
    return at, h


def smallest(h: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """The ``keep`` smallest distinct hashes, ascending."""
    if len(h) > 8 * keep:  # the smallest distinct ones are among the smallest with repeats, if enough of these differ
        part = np.unique(np.partition(h, 4 * keep)[:4 * keep])
        if len(part) >= keep:
            return part[:keep]
    return np.unique(h)[:keep]


def printed(h: np.ndarray) -> str:
    return h.astype(">u4").tobytes().hex()


def parsed(fp: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fp), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    """Jaccard estimate from two sketches; exact while both sets are within ``keep``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.intersect1d(a, b, assume_unique=True)
    if len(a) < keep and len(b) < keep:
        return len(both) / (len(a) + len(b) - len(both))
    union = np.union1d(a, b)[:keep]
    return len(np.intersect1d(union, both, assume_unique=True)) / len(union)


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per document: id, its anchors in order (array of pos, hash) and its fingerprint."""

    def run(cols):
        places, prints = [], []
        for t in cols[1]:
            at, h = anchors_of(t or "", k, s)
            places.append([{"pos": int(p), "hash": int(x)} for p, x in zip(at, h)])
            prints.append(printed(smallest(h)))
        yield {"id": cols[0], "anchors": places, "fingerprint": prints}

    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col), run,
                       f"id {t}, anchors array<struct<pos:bigint,hash:bigint>>, fingerprint string"
                       ).withColumnRenamed("id", id_col)


def with_next(df: DataFrame, id_col: str, text_col: str, rows_per_part: int = 4000) -> DataFrame:
    """Rows dealt into ranges of the id, each range followed by the first row of the next.

    Range starts are ids that exist (``percentile_approx`` returns elements), so
    the row at a start also goes to the range before it, as its look-ahead; the
    smallest id goes to the last range, to follow the last row. Only the text's
    one shuffle moves it, and the only thing that the driver holds is the list of
    starts. Columns: part, ahead (a look-ahead row), id, text. Null ids sort first.
    """
    n, low, empty = df.select(F.count("*"), F.min(id_col), F.count(F.when(F.col(id_col).isNull(), 1))).first()
    parts = max(1, min(10_000, -(-n // rows_per_part)))
    first = None if empty else low
    starts: list = []
    if parts > 1 and low is not None:
        got = df.select(F.percentile_approx(id_col, [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
        starts = sorted({x for x in got if x is not None and (x != low or empty)})
    parts = len(starts) + 1
    c = F.col(id_col)
    part, at_start = F.lit(0), F.lit(False)
    if starts:
        # starts at or below the id, by bisection: the work per row grows with the log of the parts
        lits = F.array(*[F.lit(x) for x in starts])
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(starts).bit_length()))])
        part = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(lits, n + step - 1) <= c, n + step).otherwise(n))
        at_start = F.coalesce(F.get(lits, part - 1) == c, F.lit(False))
    is_first = c.isNull() if first is None else c == F.lit(first)
    ahead = F.when(is_first, F.lit(parts - 1)).otherwise(F.when(at_start, part - 1))
    own = F.struct(part.cast("int").alias("part"), F.lit(0).alias("ahead"))
    more = F.struct(ahead.cast("int").alias("part"), F.lit(1).alias("ahead"))
    dealt = df.select(F.explode(F.when(ahead.isNull(), F.array(own)).otherwise(F.array(own, more))).alias("_d"),
                      c.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (dealt.select("_d.part", "_d.ahead", "id", "text")
            .repartitionById(parts, F.col("part")).sortWithinPartitions("part", "ahead", F.asc_nulls_first("id"), "text"))


def fingerprint_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = K, s: int = S, keep: int = KEEP) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text's are.

    The edited text replaces the last quarter (floor) of the code points by the
    first as many of the next document in order of id (after the last: the first).
    Anchors that lie wholly in the kept part are the text's own, so only the
    stretch from k - 1 code points before the edit is scanned again.
    """
    t = dict(df.dtypes)[id_col]
    schema = (f"id {t}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    import pyarrow as pa

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    class Doc:
        def __init__(self, i, text):
            self.i, self.text, self.codes = i, text, _codes(text)
            self.at, self.h = syncmers(self.codes, k, s)
            self.fp = smallest(self.h if len(self.at) else _whole(self.codes), keep)

    def against(d: Doc, nxt: Doc) -> tuple:
        n = len(d.codes)
        cut_at = n - n // 4
        new = np.concatenate([d.codes[:cut_at], nxt.codes[:n // 4]])
        again = max(0, cut_at - k + 1)
        _, h = syncmers(new[again:], k, s)
        h = np.concatenate([d.h[:np.searchsorted(d.at, again)], h])
        fp = smallest(h if len(h) else _whole(new), keep)
        return (d.i, n, sha(d.text[:cut_at] + nxt.text[:n // 4]), printed(d.fp), printed(fp),
                likeness(d.fp, fp, keep), likeness(d.fp, nxt.fp, keep))

    def run(batches):
        part = last = None  # a row waits for the row after it
        waits = False
        for b in batches:
            out = []
            for p, ahead, i, text in zip(*[c.to_pylist() for c in b.columns]):
                if p == part and not waits:
                    continue  # further look-ahead rows (repeated ids)
                d = Doc(i, text)
                if p == part and last is not None:
                    out.append(against(last, d))
                part, last, waits = p, d, not ahead
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return with_code(with_next(df, id_col, text_col)).mapInArrow(run, schema).withColumnRenamed("id", id_col)
