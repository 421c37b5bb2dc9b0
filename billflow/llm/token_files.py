"""Token ids in binary files, packed by an adaptive context-mixing range coder.

Coder. A block of at most ``BLOCK`` ids is cut into lanes of consecutive ids that are
coded side by side, one id of every lane at a time, so that a step is a few array
operations. Three models predict the next id of a lane: order 2 and order 1 name the id
that last held its ground after these ids, each with a confidence; order 0 is the
frequency of ids so far. The mix gives each model a weight, learned for each pair of
confidences from how often the models were right there: the probability of an id is
weight 0 times its frequency, plus weight 1 if order 1 named it, plus weight 2 if order 2
did. One range coder step codes the id under that mix (64-bit range, 32-bit digits;
carries go to the digit before and are settled when the block ends). The models learn
from all lanes after each step and begin anew in each block, so a block is decoded
without any other; its CRC-32 says whether it came out right. All arithmetic is in
integers: every machine decodes what another wrote.

File format. A file is a sequence of segments; a segment holds whole documents and
stands alone (little-endian; see ``HEAD`` and ``BLOCK_HEAD``):

    segment  magic, vocabulary, documents, blocks, bytes of the rest, CRC-32 of all that but itself;
             one present flag and one 64-bit id per document, one 32-bit length per
             document, then the blocks
    block    ids, lanes, bytes of the payload, CRC-32 of the ids;
             one 32-bit digit count per lane, then the digits, lane by lane

Spark writes the files: each row of the written table is a segment, (part, seq) says
where it stands, and its commit leaves nothing of a lost executor. ``segments_in`` reads
any run of segments, such as a plain file of them.

Tokens. The tokenizers library encodes each distinct stretch between ASCII white space
once per worker, while it is kept; no token of the tokenizers used here reaches across white
space, so the ids of a text are those of its stretches. Kept stretches are bounded.

Defined results: a null text counts as empty and is the end id alone; a null id is kept
as null and comes first; rows that share an id each get a result, in order of their ids'
hash; an empty table gives files without segments and an empty result. A document of any
length lies in one segment, over several blocks.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billflow.operators.joins import maybe_broadcast
from billflow.session import checkpoint_dir

from .common import cut, map_batches, with_code

END, MAX_KEPT, FILE_IDS = 2, 500_000, 1 << 26
BLOCK, LANES, LANE = 1 << 20, 4096, 256
TURN = 16  # steps whose ids are turned from lane order at once
TOTAL, SHARE, SLOTS, SURE = 26, 20, 18, 7  # bits of all weights, of order 0 at least, of order 2's slots; top confidence
MAGIC = b"BFT1"
HEAD = struct.Struct("<4sIIIQI")
BLOCK_HEAD = struct.Struct("<IIII")
_U, _I = np.uint64, np.int64
_D32, _LOW = _U(32), _U(0xFFFFFFFF)


class Damaged(ValueError):
    """A segment or block whose bytes or ids don't match their checksum."""


class Mix:
    """The three models of one block and their weights; coder and decoder drive it alike. What comes
    in pairs is of order 2, then of order 1, so that one array operation does for both."""

    def __init__(self, vocab: int, lanes: int):
        if not 0 < vocab <= 1 << 18:
            raise ValueError("ids must be below 2 ** 18")
        self.vocab = vocab
        # id << 3 | confidence: order 2 by a hash of the two ids before, behind it order 1 by the id before
        self.held = np.zeros((1 << SLOTS) + vocab + 1, np.int32)
        self.seen = np.zeros(vocab, _I)
        self.floor = np.arange(1, vocab + 1, dtype=_I)
        self.names = np.arange(vocab, dtype=np.uint16 if vocab <= 1 << 16 else np.int32)
        self.below = np.zeros(vocab + 1, _I)
        # by (confidence 2, confidence 1), then the same again where both name one id, which counts as order 2's
        self.right, self.times = np.ones((2, 128), _I), np.full(128, 4, _I)
        self.right[1, 64:] = 0
        self.at = np.zeros((2, lanes), _I)
        self.at[1] = (1 << SLOTS) + vocab
        self.before = np.full(lanes, vocab, np.uint32)
        self.step, self.missed = 0, []
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        """below[i]: the share of ids under i, of 2 ** SHARE; every id has some."""
        if self.missed:
            self.seen += np.bincount(np.concatenate(self.missed), minlength=self.vocab)
            self.missed = []
        room = (1 << SHARE) - self.vocab
        self.owner = None
        up = self.below[1:]
        np.cumsum(self.seen, out=up)
        total = up[-1]
        if not total:
            up[:], total = self.floor, self.vocab
        up *= room
        up //= total
        up += self.floor

    def find(self, share: np.ndarray) -> np.ndarray:
        """The id that each share falls on."""
        if self.owner is None:
            self.owner = np.repeat(self.names, np.diff(self.below))
        return self.owner.take(share, mode="clip")

    def _weights(self) -> None:
        free = (1 << TOTAL) - (1 << SHARE)
        self.weights = free * self.right // self.times

    def look(self, n: int) -> None:
        """Predictions and weights for the next id of the first ``n`` lanes."""
        self.ground = self.at[:, :n]
        self.value = self.held.take(self.ground)
        self.sure = self.value.astype(np.int8)
        self.sure &= 7
        self.named = self.value >> 3
        self.same = self.named[0] == self.named[1]
        state = self.sure[0] << 3
        state |= self.sure[1]
        state |= self.same.view(np.int8) << 6
        self.state = state.astype(_I)
        self.m = self.weights.take(self.state, axis=1)
        self.m0 = (1 << TOTAL) - self.m[0]
        self.m0 -= self.m[1]

    def _under(self, ids: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The share in order 0 of what is under each id, under its weight."""
        share = self.below.take(ids)
        share *= weight
        share >>= SHARE
        return share

    def range_of(self, ids: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the range of each id begins under its mix, and how long it is (unsigned)."""
        cum, freq = self._under(ids, self.m0), self._under(ids + 1, self.m0)
        freq -= cum
        for x, which in ((cum, self.named < ids), (freq, hits)):
            more = self.m * which
            x += more[0]
            x += more[1]
        return cum.view(_U), freq.view(_U)  # neither is negative

    def holder_of(self, v: np.ndarray) -> tuple[np.ndarray, ...]:
        """The (int32) id whose range holds each number, where that range begins, how long it is (unsigned), and
        where order 2 and order 1 named it. In a range, the weight of what named the id comes before its share."""
        begin = self._under(self.named, self.m0)
        begin += self.m[::-1] * (self.named[::-1] < self.named)
        past = v - begin
        ahead = self.m * (past >= 0)
        ahead[0] += ahead[1]
        ahead = ahead[0]
        u = v - ahead  # where all ids have their share alone; below a named id if it is within that id's weight
        u += 1
        u <<= SHARE
        u -= 1
        ids = self.find((u.view(_U) // self.m0.view(_U)).view(_I)).astype(np.int32)
        for named, within in zip(self.named, past.view(_U) < self.m.view(_U)):
            at = np.flatnonzero(within)
            ids[at] = named.take(at)
        hits = self.named == ids
        cum, freq = self._under(ids, self.m0), self._under(ids + 1, self.m0)
        freq -= cum
        cum += ahead
        for m, hit in zip(self.m, hits):  # few are
            at = np.flatnonzero(hit)
            more = m.take(at)
            cum[at] -= more
            freq[at] += more
        return ids, cum.view(_U), freq.view(_U), hits

    def learn(self, ids: np.ndarray, hits: np.ndarray) -> None:
        """The (int32) ids that came, and where order 2 and order 1 had named them."""
        miss = ~hits
        neither = miss[0] & miss[1]
        new = ids << 3
        new |= 1
        # a hit adds 1 up to SURE, a miss takes 1, or the ground where there is none to take
        step = ((self.sure < SURE) & hits).view(np.int8)
        step -= miss.view(np.int8)
        value = self.value
        value += step
        value -= new
        value *= hits | (self.sure > 1)
        value += new
        self.held[self.ground] = value
        self.missed.append(ids.compress(neither))
        what = miss[0].view(np.int8) + neither.view(np.int8)  # order 2 was right (0), order 1 alone was, neither
        self.state *= 3
        self.state += what
        times = np.bincount(self.state, minlength=384).reshape(128, 3).T
        self.right += times[:2]
        for x in times:
            self.times += x
        self.step += 1
        if self.step % 16 == 0:  # what was learned long ago counts less
            for x in (self.times, self.right):
                x -= x >> 1
            self.times += 2
        if self.step < 8 or self.step % 8 == 0:
            self._frequencies()
        self._weights()
        n = len(ids)
        slot = self.before[:n] * np.uint32(0x9E3779B1)  # the bits kept are among the lower 32
        slot += ids.view(np.uint32) * np.uint32(0x85EBCA77)
        slot >>= np.uint32(13)
        slot &= np.uint32((1 << SLOTS) - 1)
        self.at[0, :n] = slot
        np.add(ids, 1 << SLOTS, out=self.at[1, :n])
        self.before[:n] = ids.view(np.uint32)


def _lanes(n: int) -> tuple[int, int, int]:
    """Number of lanes, of steps (the length of the longest), and of lanes of that length, which come first."""
    lanes = max(1, min(LANES, n // LANE))
    return lanes, -(-n // lanes), n % lanes or lanes


def pack_block(ids: np.ndarray, vocab: int) -> bytes:
    """One block, header included, of a uint32 array of ids below ``vocab``."""
    n = len(ids)
    if n and int(ids.max()) >= vocab:
        raise ValueError(f"id {int(ids.max())} in a vocabulary of {vocab}")
    lanes, steps, longest = _lanes(n)
    digit = np.zeros((steps + 1) * lanes, _U)  # step by step
    lane = np.arange(lanes)
    at = lane.copy()
    low, rng = np.zeros(lanes, _U), np.full(lanes, 2 ** 64 - 1, _U)
    mix = Mix(vocab, lanes)
    grid = np.zeros((lanes, steps), np.int32)
    whole = longest * steps
    grid[:longest] = ids[:whole].reshape(longest, steps)
    if longest < lanes:
        grid[longest:, :-1] = ids[whole:].reshape(lanes - longest, steps - 1)
    for s in range(steps):
        if s % TURN == 0:
            turned = np.ascontiguousarray(grid[:, s:s + TURN].T)
        k = lanes if s < steps - 1 else longest
        a = turned[s % TURN, :k]
        mix.look(k)
        hits = mix.named == a
        add, freq = mix.range_of(a, hits)
        r = rng[:k] >> _U(TOTAL)
        add *= r
        low[:k] += add
        over = np.flatnonzero(low[:k] < add)
        if len(over):
            digit[at[over] - lanes] += _U(1)
        np.multiply(r, freq, out=rng[:k])
        out = np.flatnonzero(rng[:k] <= _LOW)
        here, digits = at.take(out), low.take(out)
        digit[here] = digits >> _D32
        at[out] = here + lanes
        low[out] = digits << _D32
        rng[out] = rng.take(out) << _D32
        mix.learn(a, hits)
    if n:  # one more digit names a number within the last range
        up = (low & _LOW) > 0
        digit[at] = (low >> _D32) + up
        at += lanes
    count = at // lanes
    most = int(count.max())
    table = digit[:most * lanes].reshape(most, lanes)
    for i in range(most - 1, 0, -1):
        table[i - 1] += table[i] >> _D32
    digits = table.astype("<u4").T  # the lower 32 bits
    payload = count.astype("<u4").tobytes() + digits[np.arange(most) < count[:, None]].tobytes()
    return BLOCK_HEAD.pack(n, lanes, len(payload), zlib.crc32(ids.astype("<u4").tobytes())) + payload


def unpack_block(data: bytes, at: int, vocab: int) -> tuple[np.ndarray, int]:
    """The ids of the block that begins at ``at``, and where the next one begins."""
    n, lanes, nbytes, crc = BLOCK_HEAD.unpack_from(data, at)
    at += BLOCK_HEAD.size
    expect, steps, longest = _lanes(n)
    if lanes != expect or at + nbytes > len(data):
        raise Damaged("block header")
    words = np.frombuffer(data, "<u4", nbytes // 4, at)
    count, packed = words[:lanes].astype(_I), words[lanes:]
    if int(count.sum()) != len(packed):
        raise Damaged("digits of a block")
    lane = np.arange(lanes)
    here = np.cumsum(count + 1) - (count + 1)
    digits = np.zeros(len(packed) + lanes + 1, np.uint32)  # a lane is read one digit past its end, which is 0
    digits[np.arange(len(packed)) + np.repeat(lane, count)] = packed
    off = digits.take(here, mode="clip").astype(_U) << _D32 | digits.take(here + 1, mode="clip")
    here += 2
    rng = np.full(lanes, 2 ** 64 - 1, _U)
    grid = np.zeros((lanes, steps), np.int32)
    turned = np.zeros((TURN, lanes), np.int32)
    mix = Mix(vocab, lanes)
    for s in range(steps):
        k = lanes if s < steps - 1 else longest
        mix.look(k)
        r = rng[:k] >> _U(TOTAL)
        a, cum, freq, hits = mix.holder_of((off[:k] // r).view(_I))
        cum *= r
        off[:k] -= cum
        np.multiply(r, freq, out=rng[:k])
        more = np.flatnonzero(rng[:k] <= _LOW)
        place = here.take(more)
        off[more] = off.take(more) << _D32 | digits.take(place, mode="clip")
        here[more] = place + 1
        rng[more] = rng.take(more) << _D32
        turned[s % TURN, :k] = a
        if s % TURN == TURN - 1 or s == steps - 1:
            lo = s - s % TURN
            grid[:, lo:s + 1] = turned[:s + 1 - lo].T
        mix.learn(a, hits)
    ids = np.concatenate([grid[:longest].ravel(), grid[longest:, :-1].ravel()]).astype(np.uint32)
    if zlib.crc32(ids.astype("<u4", copy=False)) != crc:
        raise Damaged("ids of a block")
    return ids, at + nbytes


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray], vocab: int) -> bytes:
    """A segment of whole documents: their numbers and their (uint32) ids."""
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    blocks = [pack_block(flat[lo:lo + BLOCK], vocab) for lo in range(0, len(flat), BLOCK)]
    rest = b"".join([np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
                     np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
                     np.array([len(x) for x in ids], "<u4").tobytes(), *blocks])
    head = HEAD.pack(MAGIC, vocab, len(doc_ids), len(blocks), len(rest), 0)[:-4]
    return head + struct.pack("<I", zlib.crc32(rest, zlib.crc32(head))) + rest


def unpack_segment(data: bytes, at: int = 0) -> tuple[list[int | None], list[np.ndarray], int]:
    """Document numbers, the ids of each document, and where the next segment begins."""
    if len(data) < at + HEAD.size:
        raise Damaged("segment header")
    magic, vocab, docs, blocks, nbytes, crc = HEAD.unpack_from(data, at)
    whole, begin, at = memoryview(data), at, at + HEAD.size
    stop = at + nbytes
    if magic != MAGIC or stop > len(data) or zlib.crc32(whole[at:stop], zlib.crc32(whole[begin:at - 4])) != crc:
        raise Damaged("segment")
    there = np.frombuffer(data, np.uint8, docs, at)
    numbers = np.frombuffer(data, "<i8", docs, at + docs)
    size = np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(_I)
    at += 13 * docs
    got = []
    for _ in range(blocks):
        ids, at = unpack_block(data, at, vocab)
        got.append(ids)
    flat = np.concatenate(got) if got else np.empty(0, np.uint32)
    if at != stop or int(size.sum()) != len(flat):
        raise Damaged("lengths of a segment")
    ends = np.cumsum(size).tolist()
    return ([n if t else None for t, n in zip(there.tolist(), numbers.tolist())],
            [flat[lo:hi] for lo, hi in zip([0, *ends], ends)], stop)


def segments_in(data: bytes) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """The documents of each segment of a run of segments."""
    at = 0
    while at < len(data):
        numbers, ids, at = unpack_segment(data, at)
        yield numbers, ids


# Fixed values of the word tokenizer's file: what it does before BPE.
LOWERED = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Bytes that U+0300 to U+037F begin with: such a mark may compose with a small letter and not with its capital.
COMPOSES = b"\xcc", b"\xcd"
# The bytes of which, in UTF-8, only letters of Latin-1 are made, ASCII ones small: a stretch of them is one pre-token; what makes its other letters small.
PLAIN = bytes([*range(0x61, 0x7B), 0xC3, *(c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7))])
SMALL = bytes(c + 0x20 if 0x80 <= c <= 0x9E else c for c in range(256))
# The pre-tokens of a stretch that also holds digits and marks, but no apostrophe;
# one whose ASCII marks at the end are a pre-token of their own, as an ASCII letter or digit, or a letter of Latin-1, stands before them.
MIXED = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MARKED = re.compile(rb"[a-z0-9]\Z|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]\Z")
SPACES = b"\t\n\v\f\r "
SPACE = re.compile(rb"[\t-\r ]")
# Of each byte: white space (0), mark (1), else (2); whether it stands before marks at the end by itself, or after 0xC3.
KIND = bytes(0 if c in SPACES else 1 if c in MARKS else 2 for c in range(256))
ALONE = np.array([MARKED.search(bytes([c])) is not None for c in range(256)])
AFTER_C3 = np.array([MARKED.search(bytes([0xC3, c])) is not None for c in range(256)])
TOGETHER = 1 << 23  # bytes of text whose stretches are told apart at once


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text, cut at white space where it is long."""
    lo = 0
    while len(text) - lo > TOGETHER and (space := SPACE.search(text, lo + TOGETHER)):
        yield text[lo:space.start()]
        lo = space.start()
    yield text[lo:] if lo else text


def _stretches(text: bytes) -> tuple[np.ndarray, tuple[np.ndarray, bytes]]:
    """Where each stretch of a text begins, marks at the end of one counted as the next, and where the text ends;
    the stretches alone, as Arrow keeps them (ends, bytes). The text ends with white space."""
    data, kind = np.frombuffer(text, np.uint8), np.frombuffer(text.translate(KIND), np.uint8)
    run = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    kinds = kind.take(run)
    marks = np.flatnonzero(kinds[1:] == 1) + 1
    marks = marks.compress((kinds.take(marks + 1) == 0) & (kinds.take(marks - 1) == 2))
    at = run.take(marks)
    last = data.take(at - 1)
    apart = ALONE.take(last) | (AFTER_C3.take(last) & (data.take(at - 2) == 0xC3))
    edge = kinds == 0
    begins = ~edge
    begins[1:] &= edge[:-1]
    begins[marks[apart]] = True
    bound = np.flatnonzero(edge | begins)
    start = run.take(bound)
    there = begins.take(bound)
    size = np.diff(start, append=len(text)).compress(there)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return np.append(start.compress(there), len(text)), (ends, text.translate(None, SPACES))


class Kept(dict):
    """What ``find`` gives for each key, found when first asked for; at most 2 * ``MAX_KEPT`` stay,
    those asked for last among them."""

    def __init__(self, find):
        self.find, self.older = find, {}

    def __missing__(self, key: bytes) -> bytes:
        got = self.older.get(key)
        if got is None:
            got = self.find(key)
        if len(self) >= MAX_KEPT:
            self.older = self.copy()
            self.clear()
        self[key] = got
        return got


class Tokens:
    """The library's ids of texts, each distinct stretch between ASCII white space encoded once.

    Where the tokenizer is the word tokenizer (``LOWERED``, ``WORDS``), ASCII is put in lower case before
    stretches are told apart (not in a text with combining marks), marks at a stretch's end are looked up apart from the rest, so are
    the pre-tokens of one of Latin-1 letters, digits and marks, and a stretch of such
    letters goes to the library's BPE model at once, its bytes spelled as the library spells them.
    Any other stretch, and any of another tokenizer, goes through the library whole. The stretches of many
    texts of the word tokenizer are told apart by arrays, and only the distinct ones are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.code, self.packed = ("H", np.uint16) if self.vocab <= 1 << 16 else ("I", np.uint32)
        steps = json.loads(self.library.to_str())
        cleaned = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])]
        cut_at = [x.get("pattern", {}).get("Regex", x["type"]) for x in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.words = cleaned == LOWERED and cut_at == [WORDS, "ByteLevel"]
        # an added token is found before anything else, in its own letters
        added = [x["content"].encode() for x in steps["added_tokens"]]
        self.added = re.compile(b"|".join(map(re.escape, added)) or b"(?!)", re.IGNORECASE)
        self.at_once = not any(x.isalpha() for x in added)  # none can be in a stretch of ASCII letters
        self.begins = sorted({c for x in added for c in (x[:1].lower(), x[:1].upper())})  # bytes without which there is none
        self.model = self.library.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        spelled = {chr(c - 0x40): as_bytes.pre_tokenize_str(chr(c))[0][0][1] for c in range(0xDF, 0x100)}
        self.letters = [(c, x) for c, x in spelled.items() if c != x]  # second bytes of small letters that another sign stands for
        self.kept = Kept(self.find)

    def find(self, stretch: bytes) -> bytes:
        if self.words and self.at_once and stretch.isalpha() and stretch.islower():  # bytes: ASCII letters alone, which the library leaves as they are
            return array(self.code, [t.id for t in self.model.tokenize(stretch.decode())]).tobytes()
        if self.words and not self._holds_added(stretch):
            word = stretch.rstrip(MARKS)
            if len(word) < len(stretch):
                if MARKED.search(word[-2:]):
                    return self.kept[word] + self.kept[stretch[len(word):]]
            elif not stretch.translate(None, PLAIN) and stretch.decode().isalpha():
                word = stretch.translate(SMALL).decode("latin-1")  # a sign for each byte
                for c, x in self.letters:
                    word = word.replace(c, x)
                return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()
            elif len(parts := MIXED.findall(stretch)) > 1 and sum(map(len, parts)) == len(stretch):
                return b"".join([self.kept[x] for x in parts])
        return array(self.code, self.library.encode(stretch.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[bytes], end: int | None) -> list[bytes]:
        """The packed ids of each (UTF-8) text, followed by ``end``."""
        last = b"" if end is None else array(self.code, [end]).tobytes()
        got: list[list[bytes]] = [[] for _ in texts]
        gc.disable()  # many small objects, none of them in a cycle
        try:
            held, size = [], 0
            for parts, text in zip(got, texts):
                if self._as_it_is(text):
                    parts.append(b"".join(map(self.kept.__getitem__, text.split())))
                    continue
                for x in _pieces(text):
                    held.append((parts, x))
                    size += len(x)
                    if size >= TOGETHER:
                        self._together(held)
                        held, size = [], 0
            self._together(held)
        finally:
            gc.enable()
        return [b"".join(parts) + last for parts in got]

    def _as_it_is(self, text: bytes) -> bool:
        return not self.words or COMPOSES[0] in text or COMPOSES[1] in text or self._holds_added(text)

    def _together(self, held: list[tuple[list[bytes], bytes]]) -> None:
        """Adds the packed ids of each text to the list beside it."""
        text = b" ".join([x for _, x in held]).lower() + b" "
        begin, values = _stretches(text)
        if not len(begin) - 1:
            return
        found = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, *map(pa.py_buffer, values)]).dictionary_encode()
        _, ends, data = found.dictionary.buffers()
        ends, data = np.frombuffer(ends, np.int32, len(found.dictionary) + 1).tolist(), data.to_pybytes()
        ids = [self.kept[data[lo:hi]] for lo, hi in zip(ends, ends[1:])]
        flat = np.frombuffer(b"".join(ids), self.packed)
        size = np.fromiter(map(len, ids), _I, len(ids)) // flat.itemsize
        first = np.cumsum(size) - size
        which = found.indices.to_numpy()
        size = size.take(which)
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = flat.take(np.repeat(first.take(which) - upto[:-1], size) + np.arange(upto[-1])).tobytes()
        stop = np.cumsum([len(x) + 1 for _, x in held])
        stop = (upto[np.searchsorted(begin[:-1], stop)] * self.packed().itemsize).tolist()
        for (parts, _), lo, hi in zip(held, [0, *stop], stop):
            parts.append(flat[lo:hi])

    def _holds_added(self, text: bytes) -> bool:
        for c in self.begins:
            if c in text:
                return self.added.search(text) is not None
        return False


_TOKENS: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One for each Python worker; what it keeps can be made again anywhere."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def encode(df: DataFrame, path: str, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id (64-bit) and ids (packed little-endian in 2 bytes, or 4 for a vocabulary above 65,536)."""

    def run(cols):
        yield {"id": cols[0], "ids": tokens(path).encode(cols[1].to_pylist(), end)}

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return map_batches(df.select(F.col(id_col).cast("long").alias("id"), text.alias("text")), run,
                       "id bigint, ids binary", lists=False)


def _pack(batches: Iterator[pa.RecordBatch], vocab: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, seq, held = TaskContext.get().partitionId(), 0, 0
    packed = np.uint16 if vocab <= 1 << 16 else np.uint32
    numbers: list[int | None] = []
    ids: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        row = {"part": [part], "seq": [seq], "n_ids": [held], "segment": [pack_segment(numbers, ids, vocab)]}
        types = {"part": pa.int32(), "seq": pa.int32(), "n_ids": pa.int64(), "segment": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(row[c], t) for c, t in types.items()], names=list(types))

    for b in batches:
        for number, flat in zip(b.column(0).to_pylist(), b.column(1)):
            doc = np.frombuffer(flat.as_buffer(), packed).astype(np.uint32)
            if numbers and held + len(doc) > BLOCK:
                yield flush()
                seq, held = seq + 1, 0
                numbers, ids = [], []
            numbers.append(number)
            ids.append(doc)
            held += len(doc)
    if numbers:
        yield flush()


def write(encoded: DataFrame, folder: str, vocab: int) -> None:
    """Write (id, packed ids) as files of segments, documents in ascending order of id over all files.

    Equal ids are dealt on by a hash of what they hold, and equal rows by where they
    stood, so no id or row that is very frequent makes one file larger than others.
    """
    spark = encoded.sparkSession
    staged = cut(encoded.withColumn("at", F.monotonically_increasing_id() % 4096))
    width = 2 if vocab <= 1 << 16 else 4
    total = (staged.agg(F.sum(F.length("ids"))).first()[0] or 0) // width
    least = min(-(-total // BLOCK), 4 * spark.sparkContext.defaultParallelism)
    order = [F.asc_nulls_first("id"), F.xxhash64("ids").asc(), F.col("at").asc()]
    dealt = staged.repartitionByRange(max(1, least, -(-total // FILE_IDS)), *order).sortWithinPartitions(*order)
    (with_code(dealt.select("id", "ids"))
     .mapInArrow(lambda b: _pack(b, vocab), "part int, seq int, n_ids bigint, segment binary")
     .write.option("compression", "uncompressed").parquet(folder))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), ids (array)."""
    return _documents(spark, folder, lambda ids: {"ids": [x.tolist() for x in ids]}, "ids array<bigint>")


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    return _documents(spark, folder, lambda ids: {
        "n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]},
        "n_tokens bigint, ids_crc32 bigint")


def _documents(spark: SparkSession, folder: str, of, columns: str) -> DataFrame:
    files = spark.read.schema("part int, seq int, n_ids bigint, segment binary").parquet(folder)

    def run(cols):
        for part, seq, data in zip(*cols):
            numbers, ids, _ = unpack_segment(data)
            ends = np.cumsum([len(x) for x in ids])
            yield {"part": [part] * len(ids), "seq": [seq] * len(ids), "doc_id": numbers,
                   "inside": [int(e) - len(x) for e, x in zip(ends, ids)], **of(ids)}

    rows = map_batches(files.select("part", "seq", "segment"), run,
                       f"part int, seq int, doc_id bigint, inside bigint, {columns}")
    # where files and segments begin: sums over one small row per file, then per segment of a file
    ahead = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select(
        F.col("part").alias("of"), ahead(Window.orderBy("part")).alias("part_start"))
    begin = (files.select("part", "seq", "n_ids", ahead(Window.partitionBy("part").orderBy("seq")).alias("inner"))
             .join(maybe_broadcast(part), F.col("part") == F.col("of"))
             .select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("part_start") + F.col("inner")).alias("base")))
    joined = rows.join(maybe_broadcast(begin), (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))
    rest = [c.split()[0] for c in columns.split(", ")]
    return joined.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), *rest)


def round_trip(df: DataFrame, path: str, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, write, read back: doc_id, start, n_tokens, ids_crc32. The files stay below ``spark.checkpoint.dir``."""
    folder = f"{checkpoint_dir(df.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(encode(df, path, end, id_col, text_col), folder, tokens(path).vocab)
    return read_digest(df.sparkSession, folder)
