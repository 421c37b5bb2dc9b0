"""The corpus pipeline: quality, line dedup, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes
what a stage kept as Parquet, in a folder of its own under the shared folder that
``spark.checkpoint.dir`` names, and the next stage reads it. All stages but the last
return the columns of documents. Every stage works on whole texts and on all that
the stage before it kept.

Nulls in any column, empty and very long texts, repeated rows, an empty table and
extra columns of any name go through every stage as its operator's docstring says: a
null or empty text is scored, has no lines to drop, is linked with nothing, weighs
nothing in the mix (and so is not taken) and has no tokens. The folders of a run stay,
so that a run can be looked at or taken up from any stage; whoever owns the shared
folder clears it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billflow.llm import bpe, lines, minhash, mixing, quality
from billflow.llm.queries import quality_model, tokenizer_path
from billflow.session import checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labels outside the held-out fold."""
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), keep=docs.columns)
    return scored.filter(F.col("score") >= quality.ACCEPT).select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that are boilerplate on their source, whatever its size; n_chars follows the text."""
    done = lines.drop_lines(docs, F.col("source"), F.col("text"), docs.columns)
    clean = F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("clean"))
    made = {"text": clean, "n_chars": F.when(F.col("n_dropped") > 0, F.length("clean")).otherwise(F.col("row.n_chars"))}
    types = dict(docs.dtypes)
    return done.select(*[made.get(c, F.col("row")[c]).cast(types[c]).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("line_dedup", drop_boilerplate), ("near_dedup", drop_copies),
          ("mixing", mix_sources), ("bpe", encode_tokens)]

# The classifier, the signatures and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
