"""The pipeline stage by stage against plain Python, and on odd tables."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from billflow.llm import quality as Q
from billflow.llm.queries import quality_model, tokenizer_path

from .conftest import documents, plain
from .test_lines import brute as brute_lines
from .test_minhash import brute as brute_groups
from .test_mixing import brute as brute_mix

SF = "/root/testdata/sf0.001"


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality_model(spark, docs, SF)
    sizes = Q.Sizes(model.good, model.bad)
    z = Q._design(Q.np.array([sizes.features(r.text) for r in rows.values()])) @ Q.np.array(model.weights)
    good = [r for r, x in zip(rows.values(), z) if 1 / (1 + Q.np.exp(-x)) >= Q.ACCEPT]
    stage = dict(C.STAGES)
    out = stage["quality"](spark, docs, SF).cache()
    assert plain(out.collect()) == sorted(tuple(r) for r in good) and 0 < len(good) < len(rows)

    left = {d: v[0] for d, v in brute_lines([(r.doc_id, r.text, r.source) for r in good]).items()}
    out = stage["line_dedup"](spark, out, SF).cache()
    assert out.columns == docs.columns and any(v[1] for v in left.values())
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        d: (t, len(t) if n else rows[d].n_chars) for d, (_, n, t) in left.items()}

    groups = brute_groups([(d, v[2], "") for d, v in left.items()], 5)
    kept = sorted(d for d, (_, top) in groups.items() if d == top)
    out = stage["near_dedup"](spark, out, SF).cache()
    assert sorted(r.doc_id for r in out.collect()) == kept and len(kept) < len(left)

    mixed = brute_mix([(d, left[d][2], rows[d].source) for d in kept])
    out = stage["mixing"](spark, out, SF).cache()
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d in kept for _ in range(mixed[d][0][3]))

    library = Tokenizer.from_file(tokenizer_path())
    for r in stage["bpe"](spark, out, SF).collect():
        ids = library.encode(left[r.doc_id][2], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_small_sources_lose_boilerplate_too(spark):
    rows = [(i, f"own text {i}\nmenu | home", f"s{n}") for n in range(1, 10) for i in range(10 * n, 11 * n)]
    out = dict(C.STAGES)["line_dedup"](spark, documents(spark, rows), SF)
    assert {r.doc_id: r.text for r in out.collect()} == {
        i: t if s == "s1" else f"own text {i}" for i, t, s in rows}  # one page alone shares nothing


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in C.STAGES:
        docs = f(spark, docs, SF).cache()
    assert plain(C.run(spark, SF).collect()) == plain(docs.collect())


@pytest.mark.parametrize("table", ["messy", "empty"])
def test_odd_tables(spark, request, table):
    docs = request.getfixturevalue(table)
    for name, f in C.STAGES:
        out = f(spark, docs, SF)
        n = out.count()
        assert out.columns == (docs.columns if name != "bpe" else out.columns)
        assert (n > 0) == (table == "messy"), name
        docs = out
