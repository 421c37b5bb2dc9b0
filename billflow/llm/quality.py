"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from texts labelled good and one
from texts labelled bad. A text is compressed with each, piece by piece (so that
the dictionary, not the text's own past, explains it at any length), and with
neither. The normalised size difference, and how far the text compresses at all,
go through a logistic calibration to a score between 0 and 1. Labels, ids and
other columns are never inputs of a score.

The fit uses a bounded sample (``PER_CLASS`` labelled documents of each class,
taken by the order of a hash, ``MAX_CHARS`` code points of each from a hashed
offset): half of it makes the dictionaries, the other half calibrates them.
Scoring compresses every whole text and needs no shuffle.

Defined results: null text counts as empty; the empty text has no difference and
scores what the calibration gives there; ids with contradictory labels, null
labels or null ids are not learned from; with fewer than ``LEAST`` texts of a
class to learn from, every score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import unit_hash, with_code

PER_CLASS, MAX_CHARS, LEAST = 1500, 8000, 8
PIECE, DICT_BYTES, LEVEL = 4096, 112_640, 3
ACCEPT = 0.7  # scores from here on are predicted good


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    weights: tuple[float, ...] = ()
    share: float = 0.5


def _pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


class Sizes:
    """Compressed sizes of a text with the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = []
        for d in (good, bad, None):
            kept = zstandard.ZstdCompressionDict(d) if d else None
            if kept:
                kept.precompute_compress(level=LEVEL)
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            self.by.append(zstandard.ZstdCompressor(dict_data=kept, level=LEVEL, write_content_size=False,
                                                    write_checksum=False, write_dict_id=False) if kept
                           else zstandard.ZstdCompressor(compression_params=params))

    def features(self, text: str) -> tuple[float, float]:
        pieces = _pieces(text)
        if not pieces:
            return 0.0, 1.0
        good, bad, none = (sum(len(c.compress(p)) for p in pieces) for c in self.by)
        return (bad - good) / max(good, bad), min(1.0, none / sum(map(len, pieces)))


def _design(x: np.ndarray) -> np.ndarray:
    d, r = x[:, 0], x[:, 1]
    low = np.minimum(r, 0.3)  # text that repeats itself compresses to little; beyond 0.3 the ratio says nothing
    return np.column_stack([np.ones(len(x)), d * 10, low * 10])


def calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.01) -> tuple[float, ...]:
    """Weighted ridge logistic regression by Newton steps."""
    a, beta = _design(x), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - ridge * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(beta)


def _own_lines(texts: list[str], counts: Counter) -> list[bytes]:
    """Pieces of the lines that no other sampled text has: shared lines say nothing of quality."""
    out = []
    for t in texts:
        out.extend(_pieces("\n".join(x for x in t.split("\n") if counts[x] < 2)))
    return out


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little to choose from: the texts themselves serve
        return b"".join(samples)[-DICT_BYTES:]


def sample(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, max_chars: int) -> DataFrame:
    """(id, y, u, t): one non-empty stretch of text for each chosen id (id, y, u), reduced map-side to one row an id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    offset = (F.greatest(F.length(text) - max_chars, F.lit(0)) * F.col("u")).cast("int") + 1
    return (docs.select(F.col(id_col).alias("id"), text_col)
            .join(F.broadcast(chosen), "id")  # at most 2 * per_class rows
            .select("id", "y", "u", F.substring(text, offset, F.lit(max_chars)).alias("t")).filter("t <> ''")
            .groupBy("id", "y", "u").agg(F.min("t").alias("t")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Learn from the labelled ids given; the sample that reaches the driver is bounded by the two limits."""
    named = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)")
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y1")).filter("y = y1").select("id", "y"))
    counts = dict(named.groupBy("y").count().collect())
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    chosen = None
    for y in (0, 1):
        part = named.filter(F.col("y") == y).withColumn("u", unit_hash("id", seed=8)).orderBy("u", "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = sample(docs, chosen, id_col, text_col, max_chars).collect()
    rows = sorted(((r.u, r.id, r.y, r.t) for r in rows), key=lambda r: (r[0], str(r[1])))
    by = {y: [t for _, _, z, t in rows if z == y] for y in (0, 1)}
    if min(map(len, by.values())) < LEAST:
        return Model(share=share)
    counts = Counter(x for y in (0, 1) for t in by[y] for x in set(t.split("\n")))
    good, bad = (_dictionary(_own_lines(by[y][::2], counts)) for y in (1, 0))
    sizes = Sizes(good, bad)
    held = [(sizes.features(t), y) for y in (0, 1) for t in by[y][1::2]]
    x, y = np.array([f for f, _ in held]), np.array([v for _, v in held], float)
    w = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    return Model(good, bad, calibrate(x, y, w), share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Per row: id and score; with ``keep``, a struct ``row`` of those columns and score."""
    cols = keep or [id_col]
    names = [f"c{i}" for i in range(len(cols))]
    made = docs.select(F.col(text_col).alias("t"), *[F.col(c).alias(n) for c, n in zip(cols, names)])
    schema = StructType([*made.schema.fields[1:], StructField("score", DoubleType())])

    def run(batches):
        sizes = Sizes(model.good, model.bad) if model.weights else None
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            if sizes:
                z = _design(np.array([sizes.features(t) for t in texts]).reshape(-1, 2)) @ np.array(model.weights)
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            else:
                p = np.full(len(texts), model.share)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p, pa.float64())], names=[*names, "score"])

    out = with_code(made).mapInArrow(run, schema)
    if keep is None:
        return out.select(F.col("c0").alias(id_col), "score")
    return out.select(F.struct(*[F.col(n).alias(c) for n, c in zip(names, cols)]).alias("row"), "score")


def held_out(id_col: str) -> "F.Column":
    """The fold that is never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2
