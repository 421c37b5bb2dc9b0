"""Encoding and decoding against the tokenizers library, and each word against a plain merge loop."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from billflow.llm import bpe as B
from billflow.llm.queries import tokenizer_path

from .conftest import by_id, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    rng = random.Random(2)
    bits = ["Hello", "wörld's", "12", "ΣΑΣ", "İ", "\x1c", "\x85", " ", "aaaa" * 9, "ab" * 30, "é", "é", "한국어",
            "日本", "😀👍🏽", "<|startoftext|>", "<|endoftext|>", "<|", "'LL", "'s", "½", "ﬁ", "　", "\n", "  ", "\t", ".,!?",
            "​", "ſ", "K"]
    return ["", " "] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(600)]


def test_equals_the_library(spark, library):
    texts = odd_texts()
    got = by_id(B.round_trip(documents(spark, [(i, t, "s") for i, t in enumerate(texts)]), tokenizer_path()))
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        r, = got[i]
        assert r.n_tokens == len(ids), t
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), t
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest(), t


def test_index_equals_a_merge_loop():
    v = B.Vocabulary(tokenizer_path())
    rank = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(v.left, v.right, v.made))}

    def plain(word):
        s = [int(v.byte[c]) for c in word[:-1]] + [int(v.last_byte[word[-1]])]
        while True:
            best = min(((rank[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
            if best is None:
                return s
            i = best[1]
            s[i:i + 2] = [rank[s[i], s[i + 1]][1]]

    rng = random.Random(4)
    words = [bytes(rng.choice(b"aabbthenigr\xc3\xa9") for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    words += [b"a" * n for n in range(1, 40)]
    assert B.encode_words(words, v) == [plain(w) for w in words]


def test_small_blocks_and_forgetting(monkeypatch):
    texts = odd_texts()
    want = list(B.Encoder(tokenizer_path()).encode(texts))
    monkeypatch.setattr(B, "MAX_KEPT", 20)
    monkeypatch.setattr(B, "MAX_NEW", 7)
    assert list(B.Encoder(tokenizer_path()).encode(texts)) == want


def test_general_interface(spark, library, messy, empty):
    coded = B.encode(messy, tokenizer_path())
    got = by_id(coded)
    assert got[2][0].ids == [] and len(got[1]) == 2 and None in got
    back = by_id(B.decode(coded, tokenizer_path()))
    assert back[7][0].text == "alpha</w>" == back[8][0].text
    assert B.round_trip(empty, tokenizer_path()).count() == 0


def test_every_code_point(library):
    """Each code point between letters, as the library reads it; also those newer than Python's own tables."""
    e = B.Encoder(tokenizer_path())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or 0xA000 <= c < 0xAC00 or 0xD7A4 <= c < 0x20000
                                                                          or c % 16 == 0 or any(a <= c <= b for a, b in B.LATER))]
    for lo in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}b" for c in points[lo:lo + 20_000]]
        want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        assert [t for t, w, g in zip(texts, want, e.encode(texts)) if w != g] == []
