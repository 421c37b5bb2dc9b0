"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, hnsw, lines, minhash, mixing, negatives, personal, quality, secrets, spelling, syncmers, token_files,
               urls)
from .common import read


def tokenizer_path() -> str:
    """The public tokenizer file, installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(read(spark, sf_dir, "documents")))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edited(read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learned from the labelled documents outside the held-out fold."""
    labels = read(spark, sf_dir, "labels").filter(~quality.held_out("doc_id"))
    return quality.fit(docs, labels)


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= quality.ACCEPT, 1).otherwise(0).alias("predicted"))


def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return personal.personal_digest(personal.find_personal(docs, personal.fit(docs)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = lines.drop_lines(pages, lines.host_of(F.col("url")), lines.html_lines(F.col("html")), ["page_id", "url"])
    return done.select("row.page_id", lines.host_of(F.col("row.url")).alias("host"), "n_lines", "n_dropped",
                       F.sha2("clean", 256).alias("clean_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list log over the hosts of the pages (the tables hold none): drawn from hashes of each host.

    Hosts and the domains above them get entries (list, key, day, adds): of 16 in
    4 a host is blocked, later released, and in part blocked again; of 16 in 2 it
    is allowed; a domain above is blocked and later released.
    """
    hosts = pages.select(lines.host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    drawn = hosts.select("host", F.md5("host").alias("h"),
                         F.expr("array_join(slice(split(host, '[.]'), 2, size(split(host, '[.]'))), '.')").alias("up"))
    n = lambda at, size: f"cast(conv(substring(h, {at}, {size}), 16, 10) as int)"
    day = f"({n(1, 3)} % 500)"
    entry = lambda kind, key, at, adds, drawn: (
        f"named_struct('list', '{kind}', 'key', {key}, 'day', {at}, 'adds', {adds}, 'drawn', {drawn})")
    logs = drawn.selectExpr("inline(array(" + ", ".join([
        entry("block", "host", day, "true", f"{n(4, 1)} < 4"),
        entry("block", "host", f"{day} + 1 + {n(5, 2)}", "false", f"{n(4, 1)} < 4"),
        entry("block", "host", f"{day} + 300", "true", f"{n(4, 1)} < 2"),
        entry("allow", "host", f"{day} + 20", "true", f"{n(4, 1)} in (3, 4)"),
        entry("block", "up", f"100 + {n(7, 1)}", "true", "up like '%.%'"),
        entry("block", "up", f"160 + {n(8, 1)}", "false", "up like '%.%'")]) + "))").filter("drawn")
    return logs.select("list", "key", "day", "adds")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", F.expr("cast(pmod(page_id * 7919, 730) as int)"))
    return urls.evaluate(captures, list_entries(pages), "page_id", "url", "day")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_secrets, op2_line_dedup, op3_syncmers, op4_bpe, op5_mixing, op6_minhash, op7_hnsw, op8_quality, op9_url_filter,
    op10_personal, op11_spelling, op12_token_files, op13_negatives)}
