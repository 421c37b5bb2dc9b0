"""op8_quality against its definition, text by text on the driver, over the whole given table."""

import math

import numpy as np
import pytest
import zstandard

from billflow.llm import quality as Q
from billflow.llm.queries import op8_quality

SF = "/root/testdata/sf0.001"


def size(text, dictionary):
    """Compressed bytes of the text's pieces, each with a compressor of its own."""
    raw, total = text.encode(), 0
    for lo in range(0, len(raw), Q.PIECE):
        if dictionary:
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), level=Q.LEVEL,
                                         write_content_size=False, write_checksum=False, write_dict_id=False)
        else:
            c = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(
                Q.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS))
        total += len(c.compress(raw[lo:lo + Q.PIECE]))
    return total


def score(text, m):
    good, bad, none = (size(text, d) for d in (m.good, m.bad, None))
    difference = (bad - good) / max(good, bad) if text else 0.0
    ratio = none / len(text.encode()) if text else 1.0
    one, d, r = m.weights
    return 1 / (1 + math.exp(-(one + d * 10 * difference + r * 10 * min(0.3, ratio))))


def test_every_score_is_what_the_sizes_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(~Q.held_out("doc_id"))
    model = Q.fit(docs, labels)
    assert model.good and model.bad and model.weights
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in op8_quality(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = score(text, model)
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].predicted == int(got[i].score >= Q.ACCEPT)


def test_calibration_is_the_best_fit():
    """No step away from the weights found makes the penalised likelihood larger."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(0, 0.1, 300), rng.uniform(0.1, 0.9, 300)])
    y = (rng.random(300) < 1 / (1 + np.exp(-20 * x[:, 0]))).astype(float)
    w = rng.uniform(0.5, 2, 300)
    a = np.column_stack([np.ones(300), 10 * x[:, 0], 10 * np.minimum(0.3, x[:, 1])])

    def value(beta):
        z = a @ beta
        return float(np.sum(w * (y * z - np.log1p(np.exp(z)))) - 0.01 / 2 * beta @ beta)

    found = np.array(Q.calibrate(x, y, w))
    best = value(found)
    for _ in range(200):
        assert value(found + rng.normal(0, 0.05, 3)) < best
