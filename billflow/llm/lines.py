"""Line dedup by site-relative frequency; DataFrame functions only.

Pages are grouped by host. A line's boilerplate ratio is the number of the
host's pages that contain it over the number of the host's pages; lines above
the ratio and on two pages or more are dropped wherever they stand, on hosts of any
size. Lines are compared trimmed; blank lines are never counted nor dropped on their own
account.

Lines travel as 128-bit hashes and are counted map-side before the shuffle, each
once per page, so neither a hot host nor a line that every page has gathers in a
task; texts are not shuffled. Of one host, fewer than (mean distinct lines of a
page) / ratio lines can be above the ratio, so a host's list of dropped lines is
bounded whatever its pages number; the lists are broadcast when all of them
together are small (checked), and else joined by host, the pages salted. A line is looked
up by the first half of its hash; the second half decides on a hit.

Defined results: a null text counts as empty; pages without a host (null) are
left whole; a page whose lines would all go is left whole, as it has no content
that boilerplate surrounds (the duplicate stages deal with such pages), and its
n_over tells it from a page without boilerplate; a repeated row counts as another page; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

RATIO, SALTS, BROADCAST_LINES = 0.1, 32, 100_000


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL, without user, port and a leading www.; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """The visible text of an HTML page, one line for each block element."""
    # what is no text, and line breaks, in one pass that stops only at "<" and at breaks
    text = F.regexp_replace(html, r"(?is)[<\r\n](?:(?<=[\r\n])[\r\n]*|(?<=<)(?:script[^>]*>.*?</script>"
                                  r"|style[^>]*>.*?</style>|!--.*?-->))", " ")
    block = r"(?i)</?(?:p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|nav|article|section|header|footer|title|body|head|html)(?:\s[^>]*)?/?>"
    text = F.regexp_replace(text, block, "\n")
    return F.regexp_replace(text, r"<[^>]*>", "")


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(17), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(host, text) -> (host, drop): for each host with any, the keys of its lines above the ratio."""
    named = pages.filter("host is not null")
    totals = named.groupBy("host").agg(F.count("*").alias("pages"))
    # distinct as strings: structs are compared each with each
    once = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _trim), lambda x: x != ""))
    counted = (named.select("host", F.explode(F.transform(once, _key)).alias("key"))
               .groupBy("host", "key").agg(F.count("*").alias("on")).filter("on > 1"))
    return (counted.join(totals, "host").filter(F.col("on") > ratio * F.col("pages"))
            .groupBy("host").agg(F.collect_list("key").alias("drop")))


def drop_lines(df: DataFrame, host: Column, text: Column, keep: list[str], ratio: float = RATIO) -> DataFrame:
    """Per row: a struct ``row`` of the columns ``keep``, n_lines, n_dropped, n_over, clean (the text left).

    n_over counts the lines that are boilerplate. It is n_dropped, but on a page left whole for
    having no others, where n_dropped is 0.
    """
    pages = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), host.alias("host"),
                      F.coalesce(text, F.lit("")).alias("text"))
    lists = cut(boilerplate(pages.select("host", "text"), ratio))
    if (lists.agg(F.sum(F.size("drop"))).first()[0] or 0) <= BROADCAST_LINES:
        both = pages.join(F.broadcast(lists), "host", "left")
    else:
        salted = lists.select("host", "drop", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        both = (pages.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
                .join(salted, ["host", "salt"], "left"))
    lines = F.split("text", "\n")
    gone = lambda x: (F.array_contains(F.col("drop")["a"], F.xxhash64(_trim(x)))
                      & F.array_contains(F.col("drop"), _key(_trim(x))))
    left = F.when(F.col("drop").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~gone(x)))
    out = both.select("row", "text", F.size(lines).alias("n_lines"), left.alias("left"))
    whole = ~F.exists("left", lambda x: _trim(x) != "")
    n_left = F.when(whole, F.col("n_lines")).otherwise(F.size("left"))
    n_over = F.col("n_lines") - F.size("left")
    return out.select("row", F.col("n_lines").cast("long").alias("n_lines"),
                      (F.col("n_lines") - n_left).cast("long").alias("n_dropped"), n_over.cast("long").alias("n_over"),
                      F.when(whole, F.col("text")).otherwise(F.array_join("left", "\n")).alias("clean"))
