"""Held-out accuracy of the classifier, and what it does without much to learn from."""

import zlib

from pyspark.sql import functions as F

from billflow.llm import quality as Q
from billflow.llm.queries import op8_quality

from .conftest import by_id, documents


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op8_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_runs_agree_and_labels_are_no_input(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(~Q.held_out("doc_id"))
    model = Q.fit(docs, labels)
    a = by_id(Q.score(docs, model))
    b = by_id(Q.score(docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("q").alias("lang")), Q.fit(docs, labels)))
    assert all(b[i + 7][0].score == r[0].score for i, r in a.items())


def test_odd_rows(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (4, 1, 1), (7, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = Q.fit(messy, labels)
    assert model.weights == () and model.share == 0.5  # too few texts to learn from
    got = Q.score(messy, model, keep=messy.columns[:5])
    assert got.columns == ["row", "score"] and got.select("row.*").columns == messy.columns[:5] and got.count() == 12
    assert Q.fit(empty, labels.limit(0)).weights == () and Q.score(empty, model).count() == 0
    texts = {i: f"good words number {i} stand here" if i % 2 else f"!!! {i} ### $$$ %%%" for i in range(80)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()] + [(90, None), (91, "")], "doc_id long, text string")
    fitted = Q.fit(docs, spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int"))
    s = {i: r[0].score for i, r in by_id(Q.score(docs, fitted)).items()}
    assert s[90] == s[91] and 0 <= s[90] <= 1
    assert min(s[i] for i in texts if i % 2) > max(s[i] for i in texts if not i % 2)


def test_sample_is_one_row_an_id(spark):
    docs = documents(spark, [(1, f"text {i}", "s") for i in range(500)] + [(2, None, "s"), (2, "", "s"), (2, "words", "s"), (3, "", "s"), (4, "not chosen", "s")])
    chosen = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.1), (3, 0, 0.2)], "id long, y int, u double")
    got = Q.sample(docs, chosen, "doc_id", "text", 100).collect()
    assert sorted((r.id, r.y, r.t) for r in got) == [(1, 1, "text 0"), (2, 0, "words")]
