"""The coder and the files against the ids that went in, and the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from billflow.llm import token_files as T

from .conftest import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
RNG = np.random.default_rng(3)


def back(ids, vocab):
    data = T.pack_block(np.array(ids, np.uint32), vocab)
    got, at = T.unpack_block(data, 0, vocab)
    assert at == len(data) and got.tolist() == [int(i) for i in ids]
    return data


@pytest.mark.parametrize("ids", [[], [0], [49_407], [5] * 3000, list(range(700)), [1, 2, 3] * 900,
                                 RNG.integers(0, 49_408, 5000), RNG.geometric(0.01, 40_000) % 49_408])
def test_block_round_trip(ids):
    back(ids, 49_408)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300).flatmap(lambda v: st.tuples(st.just(v), st.lists(st.integers(0, v - 1), max_size=1200))))
def test_any_ids(case):
    back(case[1], case[0])


def test_models_predict():
    """Order 2 learns what order 0 can't, and carries settle over long runs of sure ids."""
    text = np.tile(RNG.integers(0, 40_000, 2000), 30)
    assert len(back(text, 49_408)) < 0.4 * 2 * len(text)
    assert len(back(RNG.permutation(text), 49_408)) > 1.2 * len(text)
    assert len(back([7] * 200_000, 49_408)) < 10_000


def test_large_vocabulary_and_its_limits():
    back(RNG.integers(0, 1 << 18, 3000), 1 << 18)
    with pytest.raises(ValueError):
        T.pack_block(np.array([5], np.uint32), 5)
    with pytest.raises(ValueError):
        T.pack_block(np.array([5], np.uint32), (1 << 18) + 1)


def test_bytes_of_a_block_stay():
    """What was written by earlier code is read: lanes of two lengths, digits with carries, predictions of both orders."""
    ids = (np.arange(70_001, dtype=np.int64) ** 2 // 7 % 997).astype(np.uint32)
    ids[20_000:30_000] = ids[:10_000]
    data = back(ids, 49_408)
    assert (len(data), zlib.crc32(data)) == (14_180, 763_565_748)


def test_both_orders_are_asked_at_once(monkeypatch):
    """One array operation serves orders 2 and 1; a step of the decoder finds the ids of all lanes at once."""
    sizes = []
    find = T.Mix.find
    monkeypatch.setattr(T.Mix, "find", lambda self, share: sizes.append(len(share)) or find(self, share))
    back(np.arange(5120) % 700, 49_408)
    assert sizes == [20] * 256
    mix = T.Mix(49_408, 20)
    mix.look(20)
    assert mix.named.shape == mix.m.shape == (2, 20)


def test_segments_stand_alone(monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 1000)  # a long document lies over several blocks
    docs = [np.array(x, np.uint32) for x in (range(10), [], RNG.integers(0, 99, 3500), [2])]
    first, second = T.pack_segment([4, None, 6, -7], docs, 100), T.pack_segment([], [], 100)
    got = list(T.segments_in(first + second + first))
    assert [n for n, _ in got] == [[4, None, 6, -7], [], [4, None, 6, -7]]
    assert all((a == b).all() for a, b in zip(got[2][1], docs))


@pytest.mark.parametrize("at", [0, 9, 30, 70, 400, -1])
def test_damage_is_found(at):
    data = bytearray(T.pack_segment([1, 2], [np.arange(300, dtype=np.uint32), np.array([2], np.uint32)], 400))
    data[at] ^= 1
    with pytest.raises(T.Damaged):
        T.unpack_segment(bytes(data))
    block = bytearray(T.pack_block(np.arange(300, dtype=np.uint32), 400))
    block[-5] ^= 4
    with pytest.raises(T.Damaged):
        T.unpack_block(bytes(block), 0, 400)


def brute(rows):
    """(id, start, n, crc) of rows in order of id (null first); ties by what they hold are free."""
    library, out, start = Tokenizer.from_file(PATH), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


TEXTS = ["It's the <|endoftext|> end, don't!", "a\x0bb\x1cc d e", "ΑΣ ὈΔΥΣΣΕΎΣ. é ́x", None, "", " \n\t", "naïve 12ab３４",
         "x" * 3000, "\U0001f600‍ ok"]


def test_round_trip_as_the_library(spark):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS * 3)]
    got = T.round_trip(documents(spark, [(i, t, "s") for i, t in rows]), PATH)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(brute(rows))


def test_messy_rows(spark, messy):
    got = T.round_trip(messy, PATH).collect()
    want = brute([(r.doc_id, r.text) for r in messy.collect()])
    key = lambda x: (x[0] is not None, x[0] or 0, x[2], x[3])
    assert sorted(((r.doc_id, 0, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted([(a, 0, c, d) for a, b, c, d in want], key=key)
    spans = sorted((r.start, r.start + r.n_tokens, r.doc_id) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [s[2] for s in spans] == [w[0] for w in want]


def test_many_files_in_order(spark, monkeypatch, scratch):
    """Rows of one id over several files, none larger than others, ids in order over all of them."""
    monkeypatch.setattr(T, "FILE_IDS", 300)
    rows = [(7 if i % 3 else i, f"word{i} and more" if i % 2 else "the same text", "s") for i in range(400)]
    T.write(T.encode(documents(spark, rows), PATH), f"{scratch}/f", T.tokens(PATH).vocab)
    files = spark.read.parquet(f"{scratch}/f").groupBy("part").sum("n_ids").collect()
    assert len(files) >= 5 and max(r[1] for r in files) < 3 * 300
    got = sorted(map(tuple, T.read(spark, f"{scratch}/f").select("start", "doc_id", "ids").collect()))
    assert [g[1] for g in got] == sorted(r[0] for r in rows)
    assert all(a[0] + len(a[2]) == b[0] for a, b in zip(got, got[1:]))
    library = Tokenizer.from_file(PATH)
    want = sorted((r[0], [*library.encode(r[1], add_special_tokens=False).ids, 2]) for r in rows)
    assert sorted((g[1], list(g[2])) for g in got) == want


def test_kept_stretches_are_bounded(monkeypatch):
    monkeypatch.setattr(T, "MAX_KEPT", 5)
    t, library = T.Tokens(PATH), Tokenizer.from_file(PATH)
    texts = [f"stretch{i} of{i % 3} a text" for i in range(20)]
    for text, packed in zip(texts, t.encode([x.encode() for x in texts], None)):
        assert np.frombuffer(packed, t.packed).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(t.kept) <= 5 and len(t.kept.older) <= 5


MARKS = "aBz e\u0301\u0307\u030a\u0338 éÀ×÷ßİſK ΑΣς ½²٣ … '’\"s<|>=.,!?-_$ \u200d\x85\xa0\u3000\x1c"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(MARKS, max_size=12), st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "it'S", "'LL", "word's,", "A\u030a", "I\u0307", "é.", "12,", "..."])), max_size=8))
def test_stretches_as_whole_texts(parts):
    t, text = T.tokens(PATH), "".join(parts)
    got = np.frombuffer(t.encode([text.encode()], None)[0], t.packed).tolist()
    assert t.words and got == t.library.encode(text, add_special_tokens=False).ids


def test_letters_of_either_case_before_any_mark():
    """ASCII letters in lower case from the start, whatever combines with them; marks after any Latin-1 letter."""
    t, marks = T.tokens(PATH), [chr(c) for c in range(0x300, 0x370)]
    texts = [x + m for m in marks for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    texts += [chr(c) + x for c in range(0xC0, 0x180) for x in ("", chr(c), "ab", "\u0301", "\u0327b")] + ["aß" + chr(c) for c in range(0xA0, 0x250)]
    texts += ["a" + chr(c) + m for c in range(0xA0, 0x180) for m in (",", "'", ".'s", "|>", "=\u0338")]
    for text, packed in zip(texts, t.encode([x.encode() for x in texts], None)):
        assert np.frombuffer(packed, t.packed).tolist() == t.library.encode(text, add_special_tokens=False).ids


def test_another_tokenizer_goes_through_the_library_whole(monkeypatch):
    t = T.Tokens(PATH)
    t.words = False
    texts = ["Ab, it's <|endoftext|> é.", "", "x" * 50]
    for text, packed in zip(texts, t.encode([x.encode() for x in texts], None)):
        assert np.frombuffer(packed, t.packed).tolist() == t.library.encode(text, add_special_tokens=False).ids
    assert b"Ab," in t.kept


def test_ascii_words_and_their_marks_are_not_spelled_anew():
    t = T.Tokens(PATH)
    t.letters = None  # only words with letters beyond ASCII need it
    for text in ("plain words, and Some of them. twice twice!", "x--y <b> 'tis", ""):
        assert np.frombuffer(t.encode([text.encode()], None)[0], t.packed).tolist() == t.library.encode(text, add_special_tokens=False).ids


def test_words_of_letters_are_not_searched_for_added_tokens(monkeypatch):
    t, library = T.Tokens(PATH), Tokenizer.from_file(PATH)
    text, searched = "plain words and École, <b>", []
    monkeypatch.setattr(t, "_holds_added", lambda x: searched.append(x))
    assert np.frombuffer(t.encode([text.encode()], None)[0], t.packed).tolist() == library.encode(text, add_special_tokens=False).ids
    assert not {b"plain", b"words", b"and"} & {*searched} and "École".encode() in searched


class Seen(T.Kept):
    """Counts how often a stretch is asked for."""

    asked = 0

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_a_stretch_is_looked_up_once_for_many_texts():
    t, library = T.Tokens(PATH), Tokenizer.from_file(PATH)
    t.kept = Seen(t.find)
    texts = [f"the same words, and Some more ({i % 3})." for i in range(500)]
    for text, packed in zip(texts, t.encode([x.encode() for x in texts], None)):
        assert np.frombuffer(packed, t.packed).tolist() == library.encode(text, add_special_tokens=False).ids
    assert t.kept.asked < 60


def test_latin_letters_digits_and_marks_do_not_need_the_whole_library():
    t, library = T.Tokens(PATH), Tokenizer.from_file(PATH)
    texts = ["École Übermaß ÀÞß", "a.58@mail2.example.com 2024-01-31 4512", "é1Éà,x_y $5", "½² a×b it's Ābc ı"]
    want = [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert [np.frombuffer(x, t.packed).tolist() for x in t.encode([x.encode() for x in texts], None)] == want

    class Marks:  # the whole library is given single marks and digits alone
        def encode(self, text, **how):
            assert len(text) == 1
            return library.encode(text, **how)

    t = T.Tokens(PATH)
    t.library = Marks()
    assert [np.frombuffer(x, t.packed).tolist() for x in t.encode([x.encode() for x in texts[:3]], None)] == want[:3]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.text(MARKS + " \t\x0b\n", max_size=12), st.sampled_from(
    ["<|endoftext|>", "word's,", "é.", "É", "12,", "...", "a-b", "x1y", "Ã\xad", " "])), max_size=6).map("".join), max_size=6), st.sampled_from([None, 2]))
def test_texts_together_as_whole_texts(texts, end):
    """Texts of any kind side by side; long ones are cut at white space."""
    t, last = T.tokens(PATH), [] if end is None else [end]
    for together in (1, 10, T.TOGETHER):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(T, "TOGETHER", together)
            got = t.encode([x.encode() for x in texts], end)
        assert [np.frombuffer(x, t.packed).tolist() for x in got] == [t.library.encode(x, add_special_tokens=False).ids + last for x in texts]


def test_empty_table(spark, empty):
    assert T.round_trip(empty, PATH).count() == 0
