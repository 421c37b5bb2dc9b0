"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a partition's documents are laid out one after another as
symbols in flat arrays, linked to their neighbours. An index maps the rank of
each mergeable pair to all positions where that pair stands. Active ranks are
taken from a heap in ascending order; all positions of a rank are merged at
once, and only the neighbours' entries of the index change. Each word is thus
merged exactly as it would be alone: lowest rank first, leftmost first.

Text is read as the tokenizer file says: special tokens are cut out of the raw
text, the rest is NFC-normalised and lower-cased by code point, white space
separates, and the split pattern makes words. White space never lies inside a
word, so the unit that is kept from document to document is the stretch between
white space, with its ids packed in bytes. Kept stretches are bounded
(``MAX_KEPT``); a batch's new ones are encoded in blocks of about ``MAX_NEW``.

The library knows the letters of Unicode 16.0 and the case pairs of 17.0. Later letters,
and case pairs that Python's own tables lack, are stated below; texts that hold any take a pattern without the former.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty text; repeated rows each get their result.
"""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_batches, sha

MAX_KEPT = 250_000
MAX_NEW = 150_000

# Fixed values. Letters after Unicode 16.0, as ranges of code points.
LATER = ((0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
         (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
         (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
         (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF),
         (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
         (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
         (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
         (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
# Lower case of capitals that Unicode 16.0 and 17.0 added.
LOWER_17 = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
            0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_LATER = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER)
RARE = regex.compile(f"[{_LATER}{''.join(map(chr, LOWER_17))}]")


class Vocabulary:
    """What the tokenizer file says, in the arrays that encoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        by_id = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.packed = np.dtype(np.uint16 if len(self.tokens) <= 1 << 16 else np.uint32)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.words_16 = regex.compile(split["pattern"]["Regex"].replace(r"\p{L}", rf"[\p{{L}}--[{_LATER}]]"), regex.V1)
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in
                  (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.left, self.right, self.made = np.array(merges, np.int64).T
        code = self.left << 32 | self.right
        order = np.argsort(code, kind="stable")
        self.codes, self.code_rank = code[order], order
        # the printable stand-ins of the 256 bytes, by the byte-level rule:
        # visible bytes stand for themselves, the others for 256, 257, ...
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(seen)]
        sign = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte = np.array([vocab[sign[b]] for b in range(256)], np.int32)
        self.last_byte = np.array([vocab[sign[b] + suffix] for b in range(256)], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it never merges."""
        code = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_rank[at], -1)


class PairIndex:
    """Rank of a pair -> positions where it stands, and the ranks still to apply."""

    def __init__(self):
        self.places: dict[int, list[np.ndarray]] = {}
        self.ranks: list[int] = []

    def add(self, ranks: np.ndarray, at: np.ndarray) -> None:
        ok = ranks >= 0
        ranks, at = ranks[ok], at[ok]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        edges = np.flatnonzero(np.diff(ranks)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(ranks)]):
            r = int(ranks[lo])
            if r not in self.places:
                self.places[r] = []
                heapq.heappush(self.ranks, r)
            self.places[r].append(at[lo:hi])

    def lowest(self) -> tuple[int, np.ndarray]:
        r = heapq.heappop(self.ranks)
        at = self.places.pop(r)
        return r, np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all (non-empty) words, given as UTF-8, one after another; and where each begins."""
    if not words:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(np.fromiter((len(w) for w in words), np.int64, len(words)))
    starts = np.concatenate([[0], ends[:-1]])
    n = len(raw)
    sym = v.byte[raw]
    sym[ends - 1] = v.last_byte[raw[ends - 1]]
    after = np.arange(1, n + 1, dtype=np.int32)
    after[ends - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[starts] = -1

    index = PairIndex()
    at = np.flatnonzero(after >= 0)
    index.add(v.rank(sym[at], sym[at + 1]), at)
    while index.ranks:
        r, at = index.lowest()
        a, b, made = int(v.left[r]), int(v.right[r]), int(v.made[r])
        nxt = after[at]
        ok = (sym[at] == a) & (nxt >= 0) & (sym[nxt] == b)
        at, nxt = at[ok], nxt[ok]
        if a == b and len(at) > 1:  # a run of the same symbol: leftmost first, no overlap
            take, used = [], -1
            for i, (p, q) in enumerate(zip(at.tolist(), nxt.tolist())):
                if p != used:
                    take.append(i)
                    used = q
            at, nxt = at[take], nxt[take]
        if not len(at):
            continue
        far = after[nxt]
        sym[at] = made
        sym[nxt] = -1
        after[at] = far
        more = far >= 0
        before[far[more]] = at[more]
        prev = before[at]
        has = prev >= 0
        p = prev[has]
        index.add(np.concatenate([v.rank(sym[p], sym[at[has]]), v.rank(sym[at[more]], sym[far[more]])]),
                  np.concatenate([p, at[more]]))
    alive = sym >= 0
    return sym[alive], np.concatenate([[0], np.cumsum(alive)])[np.concatenate([starts, [n]])]


def encode_words(words: list[bytes], v: Vocabulary) -> list[list[int]]:
    """The ids of each (non-empty) word, given as UTF-8."""
    ids, bounds = merge_words(words, v)
    return [ids[lo:hi].tolist() for lo, hi in zip(bounds.tolist(), bounds[1:].tolist())]


def _lower(text: str) -> str:
    # by code point, as the tokenizer does; str.lower looks at neighbours (final sigma)
    return text.lower() if text.isascii() or "Σ" not in text else "".join(c.lower() for c in text)


class Texts(Sequence):
    """An Arrow column of texts, turned into Python one text at a time; null is empty."""

    def __init__(self, column):
        self.column = column

    def __len__(self) -> int:
        return len(self.column)

    def __getitem__(self, i: int) -> str:
        return self.column[i].as_py() or ""


class Encoder:
    """Encodes batches of texts; keeps what stretches between white space became."""

    # white space of the tokenizer's pattern; str.split also takes U+001C to U+001F
    SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
    ODD = regex.compile(r"[\x1c-\x1f]")

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.kept: dict[str, bytes] = {}

    def stretches(self, text: str) -> list[str]:
        if self.ODD.search(text):
            return [x for x in self.SPACES.split(text) if x]
        return text.split()

    def _parts(self, stretch: str) -> list[str | int]:
        """Words, and ids of special tokens, of one stretch."""
        if "<" in stretch and self.v.special_cut and self.v.special_cut.search(stretch):
            out: list[str | int] = []
            for x in self.v.special_cut.split(stretch):
                out.extend([self.v.special[x]] if x in self.v.special else self._parts(x))
            return out
        if stretch.isascii():
            if stretch.isalpha():
                return [stretch.lower()]
        else:
            stretch = unicodedata.normalize("NFC", stretch)
            if RARE.search(stretch):
                return self.v.words_16.findall(_lower(stretch).translate(LOWER_17))
        return self.v.words.findall(_lower(stretch))

    def _learn(self, new: list[str]) -> None:
        gc.disable()  # many small objects, none of them in a cycle
        try:
            self._encode_new(new)
        finally:
            gc.enable()

    def _encode_new(self, new: list[str]) -> None:
        parts = [self._parts(x) for x in new]
        words = {w: None for p in parts for w in p if isinstance(w, str)}
        ids, bounds = merge_words([w.encode("utf-8", "surrogatepass") for w in words], self.v)
        flat, at = ids.astype(self.v.packed).tobytes(), (bounds * self.v.packed.itemsize).tolist()
        for w, lo, hi in zip(words, at, at[1:]):
            words[w] = flat[lo:hi]
        for x, p in zip(new, parts):
            self.kept[x] = words[p[0]] if len(p) == 1 and isinstance(p[0], str) else b"".join(
                [words[w] if isinstance(w, str) else self.v.packed.type(w).tobytes() for w in p])

    def encode(self, texts: Sequence[str]) -> Iterator[list[int]]:
        """The ids of each text, in order."""
        lo = 0
        while lo < len(texts):
            new: set[str] = set()
            hi = lo
            while hi < len(texts) and len(new) < MAX_NEW:
                new.update(set(self.stretches(texts[hi])).difference(self.kept))
                hi += 1
            self._learn(list(new))
            for i in range(lo, hi):
                flat = b"".join(map(self.kept.__getitem__, self.stretches(texts[i])))
                yield np.frombuffer(flat, self.v.packed).tolist()
            if len(self.kept) > MAX_KEPT:  # an idle worker holds no more than that
                self.kept.clear()
            lo = hi

    def decode(self, ids: list[int]) -> str:
        """As the tokenizer decodes: without a decoder in its file, tokens joined by spaces."""
        tokens = self.v.tokens
        return " ".join([tokens[i] for i in ids])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker; what it holds can be rebuilt anywhere."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the array of token ids. ``path``: the tokenizer file, on every node."""

    def run(cols):
        yield {"id": cols[0].to_pylist(), "ids": list(encoder(path).encode(Texts(cols[1])))}

    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col), run, f"id {t}, ids array<int>", lists=False
                       ).withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id and the decoded text (null ids count as none)."""

    def run(cols):
        yield {"id": cols[0], "text": [encoder(path).decode(i or []) for i in cols[1]]}

    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, ids_col), run, f"id {t}, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(cols):
        e = encoder(path)
        number = [str(i) for i in range(len(e.v.tokens))]
        out = {"id": cols[0].to_pylist(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in e.encode(Texts(cols[1])):
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha(" ".join([number[i] for i in ids])))
            out["decoded_sha256"].append(sha(e.decode(ids)))
        yield out

    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col), run,
                       f"id {t}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", lists=False
                       ).withColumnRenamed("id", id_col)
