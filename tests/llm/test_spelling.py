"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from billflow.llm import spelling as S

from .conftest import documents

UP = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def counted(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    ns = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(ns[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(ns[w]), form[w] and n[form[w]]) for w in n}


def got(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed, n):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(["ba", "ab", "né", "en", "sto", "à", "rr"]) for _ in range(rnd.randint(3, 6))) for _ in range(40)]

    def word():
        w = rnd.choice(base[:4] if rnd.random() < 0.6 else base)
        for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abé") + w[i:], w[:i] + rnd.choice("abé") + w[i + 1:]])
        return w.upper() if rnd.random() < 0.1 else w
    return [(i, " ".join(word() + rnd.choice(["", ".", "-x", "1"]) for _ in range(60))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_matches_all_pairs(spark, seed):
    rows = corpus(seed, 150)
    want = brute(counted(rows))
    assert got(S.group_spellings(documents(spark, [(i, t, "s") for i, t in rows]))) == want
    assert len(want) > 300 and sum(w[0] is not None for w in want.values()) > 30


def test_every_edit_of_every_place(spark):
    """One edit anywhere: all signatures that a pair can share, at even and odd lengths."""
    n = {}
    for w in ("abcdefg", "aabbccdd", "zzzzzzzzz", "ñandúñandú"):
        n[w] = 1000
        for i in range(len(w)):
            for v in (w[:i] + w[i + 1:], w[:i] + "q" + w[i + 1:], w[:i] + "q" + w[i:], w[:i] + w[i] + w[i:]):
                n.setdefault(v, 3)
        n.setdefault(w + "q", 50)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(S.variants(df)) == brute(n)


def test_forms_are_followed_to_the_last(spark):
    chain = ["aaaaaaa" + "b" * i for i in range(19)]
    n = {w: 10 ** i for i, w in enumerate(chain)}
    n[chain[18]] = 9 * 10 ** 18  # the largest count there can be ends the chain
    result = got(S.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert result == brute(n)
    assert result[chain[0]][1] == chain[18]


def test_ties_go_to_the_smallest_word(spark):
    n = {"strange": 2, "strangé": 20, "strangq": 20, "sträng": 20}
    assert got(S.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute(n)


def test_anagrams_meet_only_with_a_half_in_common(spark):
    """Words of one multiset share every signature; the halves keep them from meeting all pairwise."""
    rnd = random.Random(5)
    ws = {"".join(rnd.sample("abcdefghijkl", 12)) for _ in range(400)}
    df = spark.createDataFrame([(w, 2) for w in ws], "word string, n long")
    keys = Counter((r.side, r.key) for r in S.signatures(df).collect())
    assert sum(c * (c - 1) // 2 for c in keys.values()) < len(ws)
    assert got(S.variants(df)) == brute({w: 2 for w in ws})


def test_messy_rows(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert got(S.group_spellings(messy)) == brute(counted(rows))
    assert S.group_spellings(empty).count() == 0
    nothing = documents(spark, [(1, None, "a"), (2, "", "a"), (3, "once only words", "a")])
    assert S.group_spellings(nothing).count() == 0


def test_long_words(spark):
    long = "ab" * 4000
    rows = [(1, long), (2, long), (3, long + "c"), (4, long + "c"), (5, long[1:]), (6, long[1:])]
    want = brute(counted(rows))
    assert got(S.group_spellings(documents(spark, [(i, t, "s") for i, t in rows]))) == want
