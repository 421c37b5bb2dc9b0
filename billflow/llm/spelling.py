"""Spelling variants of words: PartEnum signatures of letter multisets, an equi-join, a check.

Words are runs of letters of whole texts, counted over the corpus; this needs functions
of Spark alone, and counts are added up map-side, so no frequent word gathers anywhere.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.
A word's multiset of letters is a binary vector with one place for "at least k times this
letter". A replaced letter changes two places of it, an inserted or deleted one changes
one: near words are within Hamming distance two. PartEnum finds such pairs exactly: the
places are dealt by hash into ``PARTS`` parts; what two words differ in lies in two parts
at most, so that, of all ways to leave two parts out, one leaves both words the same
rest. A signature is a hash of that rest, of the parts left out and of the length. Words
of unlike lengths differ in one place only: for them the places are dealt into
``PARTS_ONE`` parts, and one is left out.

Multisets know no order, and anagrams would share all signatures. Near words also share
their first half or their last half, letter by letter (the halves of the shorter one), so
each signature is joined once with the first and once with the last half as part of the
key. Both are necessary conditions: no near pair is lost. A join on the key gives the
candidates, the edit distance decides, and a pair found under several keys counts once.

The form of a word is its near word of largest count, if that is ``MORE`` times the word's
own or more; forms are followed to the last, the root. A chain has no more than 19 words,
as counts grow tenfold (64-bit counts), so five joins that each double the step suffice.

Defined results: a null text has no words; a null id hashes as the empty text; repeated
rows count again; texts and words of any length are taken whole; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, with_code

LETTERS, LEAST, SEEN, ONE_IN, MORE = "A-Za-z\\u00C0-\\u00FF", 7, 2, 31, 10
PARTS, PARTS_ONE = 3, 2
SAME, SHORT, LONG = 0, 1, 2  # sides of the join: equal lengths, the shorter word, the longer one
_U = np.uint64
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, seen: int = SEEN) -> DataFrame:
    """word, n: words of ``least`` code points that occur ``seen`` times or more.

    Only A-Z are lower-cased. Where the crc32 of ``<id>:<word>`` is a multiple of 31, the
    code point at that hash modulo the length is taken out of the word: the corpus's own
    texts have few misspellings, and this plants some that every engine can reproduce.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    run = (df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
           .select("id", F.translate("run", _UP, _LOW).alias("run"))
           .select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, short).otherwise(F.col("run"))
    return (run.select(word.alias("word")).filter(F.length("word") >= least)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= seen))


def _parts(word: str, place: dict[tuple[str, int], tuple[int, int, int]]) -> list[int]:
    """Hashes of the places (letter, k) of the word's multiset: by part of PARTS, then by part of PARTS_ONE."""
    out, count = [0] * (PARTS + PARTS_ONE), {}
    for c in word:
        k = count[c] = count.get(c, 0) + 1
        at = place.get((c, k))
        if at is None:
            h = int(mix64(np.array([ord(c) << 32 | k], _U))[0])
            at = h, (h >> 32) % PARTS, PARTS + (h >> 48) % PARTS_ONE
            if len(place) < 1 << 16:
                place[c, k] = at
        out[at[1]] ^= at[0]
        out[at[2]] ^= at[0]
    return out


def _halves(word: str, at: int, rest: int) -> tuple[int, int]:
    """Hashes of the first ``at`` and the last ``rest`` code points."""
    first, last = word[:at].encode("utf-8", "surrogatepass"), word[len(word) - rest:].encode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest(first, 1), xxhash.xxh3_64_intdigest(last, 2)


def signatures_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the word, side and key of every signature of the words."""
    place: dict = {}
    size = np.array([len(w) for w in words], _U)
    part = np.array([_parts(w, place) for w in words], _U).reshape(len(words), PARTS + PARTS_ONE)
    whole = np.bitwise_xor.reduce(part[:, :PARTS], axis=1)
    own = np.array([_halves(w, len(w) // 2, len(w) - len(w) // 2) for w in words], _U).reshape(len(words), 2)
    less = np.array([_halves(w, (len(w) - 1) // 2, len(w) // 2) for w in words], _U).reshape(len(words), 2)
    sides, keys = [], []

    def add(side: int, tag: int, rest: np.ndarray, length: np.ndarray, halves: np.ndarray) -> None:
        for h in halves.T:
            sides.append(side)
            keys.append(mix64(mix64(mix64(rest ^ _U(tag)) ^ length) ^ h))

    for n, (i, j) in enumerate(combinations(range(PARTS), 2)):
        add(SAME, 1 + n, whole ^ part[:, i] ^ part[:, j], size, own)
    for i in range(PARTS_ONE):
        add(SHORT, 101 + i, whole ^ part[:, PARTS + i], size, own)
        add(LONG, 101 + i, whole ^ part[:, PARTS + i], size - _U(1), less)
    n = len(words)
    return (np.tile(np.arange(n), len(keys)), np.repeat(np.array(sides, np.int8), n),
            np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64))


def signatures(counted: DataFrame) -> DataFrame:
    """(word, n) -> (key, side, word, n): the PartEnum signatures of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                of, side, key = signatures_of(b.column(0).to_pylist())
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(side), b.column(0).take(at), b.column(1).take(at)],
                    names=["key", "side", "word", "n"])

    return with_code(counted.select("word", "n")).mapInArrow(run, "key bigint, side tinyint, word string, n bigint")


def near_pairs(counted: DataFrame) -> DataFrame:
    """(word, n) -> (a, n_a, b, n_b): every two words that differ by one code point, once."""
    rows = signatures(counted)
    x = rows.select("key", F.col("side").alias("sx"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    y = rows.select("key", F.col("side").alias("sy"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    # one condition on both sides, so that nothing is pushed below the shuffle that they share (merged: sizes are not known)
    meets = F.when(F.col("sx") + F.col("sy") == SAME, F.col("a") < F.col("b")).otherwise(
        (F.col("sx") == SHORT) & (F.col("sy") == LONG))
    met = x.join(y.hint("merge"), "key").filter(meets & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last; each join doubles the step."""
    step = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(5):  # 2 ** 5 steps, more than a chain has
        on = step.select(F.col("word").alias("at"), F.col("root").alias("further"))
        after = cut(step.join(on, F.col("root") == F.col("at"), "left").select("word", "root", "further"))
        if not after.filter("further is not null").limit(1).count():
            break
        step = after.select("word", F.coalesce("further", "root").alias("root"))
    return step


def variants(counted: DataFrame, more: int = MORE) -> DataFrame:
    """(word, n) -> word, form, root, n, n_near, form_n."""
    counted = cut(counted.select("word", "n"))
    pairs = near_pairs(counted)
    both = (pairs.select(F.col("a").alias("of"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("near")).alias("x"))
            .unionAll(pairs.select(F.col("b").alias("of"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("near")).alias("x"))))
    best = both.groupBy("of").agg(F.count("*").alias("n_near"), F.min("x").alias("x"))
    top = -F.col("x.less")
    has = F.expr(f"(-x.less) div {more} >= n")  # ten times n may be beyond 64 bits
    found = cut(counted.join(best, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("x.near")).alias("form"), F.when(has, top).alias("form_n")))
    last = roots(found.filter("form is not null")).select(F.col("word").alias("of"), "root")
    return (found.join(last, F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def group_spellings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of a corpus."""
    return variants(words(df, id_col, text_col))
