"""Secret scan by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
(AND of ORs) that every match must satisfy. Documents come in shards (the Arrow
batches of a task, bounded by rows and bytes). For each shard an inverted index
maps every trigram that some rule's query mentions to a sorted posting list of
documents; a rule's postings are united within a clause and intersected over
its clauses, and only those candidates are verified with the regular expression
itself. A rule whose expression guarantees no trigram scans the whole shard.

The index is local to its shard, so nothing is shuffled, memory is bounded by a
batch, and a lost executor costs a rerun of its own shards.

Defined results: a null text counts as empty; an empty text or table gives no
spans; repeated rows each get their own result; a null id is carried through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
from pyspark.sql import DataFrame

from .common import map_batches

Query = list[frozenset[str]]  # AND over clauses, OR within a clause; [] is "any text"

# At most so many strings are enumerated for a piece of a pattern before it is
# taken as unknown; a coarser query only makes more candidates.
EXACT_LIMIT = 64


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern, and what a match needs beyond the pattern (else it is dropped)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    query: Query = field(default_factory=list, compare=False)


def _sets(items) -> tuple[set[str] | None, list[frozenset[str]]]:
    """(all strings the items can match or None, clauses every match satisfies); lower case."""
    run: set[str] = {""}  # every string the last pieces can end in, since the last unknown
    whole, clauses = True, []

    def close() -> None:
        grams = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run]
        if grams and all(grams):
            # an AND over all strings' grams is an OR of ANDs; its clauses are
            # the choices of one gram for each string
            if len(run) == 1:
                clauses.extend(frozenset([g]) for g in sorted(grams[0]))
            else:
                for picks in zip(*[(sorted(g) * 4)[:4] for g in grams]):
                    clauses.append(frozenset(picks))

    for op, arg in items:
        known: set[str] | None = None
        if op is C.LITERAL:
            known = {chr(arg).lower()}
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            known = {chr(a).lower() for _, a in arg}
        elif op is C.SUBPATTERN:
            known, inner = _sets(arg[3])
            if known is None:
                clauses.extend(inner)
        elif op is C.BRANCH:
            parts = [_sets(x) for x in arg[1]]
            if all(k is not None for k, _ in parts):
                known = set().union(*[k for k, _ in parts])
            elif all(c for _, c in parts):
                clauses.append(frozenset().union(*[min(c, key=len) for _, c in parts]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] <= arg[1] <= 1 or \
                op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] == arg[1] and arg[1] <= 8:
            inner_known, inner = _sets(arg[2])
            if inner_known is not None and len(inner_known) ** max(1, arg[1]) <= EXACT_LIMIT:
                once = {"".join(p) for p in product(sorted(inner_known), repeat=max(1, arg[1]))}
                known = once if arg[0] else once | {""}
            elif arg[0]:
                clauses.extend(inner)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            clauses.extend(_sets(arg[2])[1])
        elif op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
            known = {""}
        if known is None or len(known) * len(run) > EXACT_LIMIT:
            close()
            run, whole = {""} if known is None else set(known), False
        else:
            run = {a + b for a in run for b in known}
    if whole:
        return run, []
    close()
    return None, clauses


def trigram_query(pattern: str) -> Query:
    """The clauses of trigrams (lower case) that any match of ``pattern`` satisfies."""
    run, clauses = _sets(_parser.parse(pattern, re.ASCII))
    if run is not None:
        # a finite pattern: close the only run by a trailing unknown
        _, clauses = _sets([*_parser.parse(pattern, re.ASCII), (C.ANY, None)])
    keep = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if all(g.isascii() for g in c):
            keep.append(c)
    return keep


# The base kinds, then further public key formats.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
]
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    # no limit on user and password: the class leaves out what ends them, so a possessive run is linear
    Rule("url_login", r"[a-z][a-z0-9+]{1,20}://[^\s/:@]++:[^\s/:@]{4,}+@"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{82}"),
]


def prepared(rules: list[Rule]) -> list[tuple[Rule, re.Pattern, Query]]:
    out = []
    for r in rules:
        pattern = r.pattern
        if r.group == 0 and r.least and re.fullmatch(r"\[[^\]]+\]\+", pattern):
            # one class repeated: a run shorter than the least length never
            # counts, and no later start in that run does better
            pattern = f"{pattern[:-1]}{{{r.least},}}"
        out.append((r, re.compile(pattern, re.ASCII), trigram_query(r.pattern)))
    return out


class ShardIndex:
    """Posting lists of one shard for the trigrams that some query mentions."""

    def __init__(self, texts: list[str], grams: dict[str, int]):
        self.grams = grams
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        lens = np.fromiter((len(b) for b in raw), np.int64, len(raw))
        starts = np.concatenate([[0], np.cumsum(lens + 2)])  # two zero bytes apart: no trigram spans texts
        table = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for g, i in grams.items():
            table[int.from_bytes(g.encode(), "big")] = i + 1
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        hits: list[np.ndarray] = []
        buf = np.frombuffer(b"\0\0".join(raw) + b"\0\0", np.uint8)
        step = 1 << 22
        for lo in range(0, max(0, len(buf) - 2), step):
            b = lower[buf[lo:lo + step + 2]].astype(np.int32)
            ids = table[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
            at = np.flatnonzero(ids)
            doc = np.searchsorted(starts, at + lo, side="right") - 1
            hits.append(np.unique(ids[at].astype(np.int64) << 32 | doc))
        pairs = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)
        bounds = np.searchsorted(pairs >> 32, np.arange(1, len(grams) + 2))
        self.postings = [pairs[bounds[i]:bounds[i + 1]] & 0xFFFFFFFF for i in range(len(grams))]

    def candidates(self, query: Query) -> np.ndarray:
        found: np.ndarray | None = None
        for clause in query:
            one = np.unique(np.concatenate([self.postings[self.grams[g]] for g in clause]))
            found = one if found is None else np.intersect1d(found, one, assume_unique=True)
            if not len(found):
                break
        return found


def scan_shard(texts: list[str], rules: list[tuple[Rule, re.Pattern, Query]]) -> list[list[tuple[int, int, int]]]:
    """For each text its (rule number, start, end) in code points."""
    grams = {g: i for i, g in enumerate(sorted({g for _, _, q in rules for c in q for g in c}))}
    index = ShardIndex(texts, grams)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, pattern, query) in enumerate(rules):
        docs = index.candidates(query) if query else range(len(texts))
        for d in docs:
            for m in pattern.finditer(texts[d]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    spans[d].append((k, m.start(), m.end()))
    return spans


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: its id and its spans (array of kind, start, end)."""
    ready = prepared(rules or BASE + MORE)
    kinds = [r.kind for r, _, _ in ready]

    def run(cols):
        ids, texts = cols[0], [t or "" for t in cols[1]]
        found = scan_shard(texts, ready)
        yield {"id": ids, "spans": [[{"kind": kinds[k], "start": s, "end": e}
                                     for k, s, e in sorted(f, key=lambda x: (x[1], x[0]))] for f in found]}

    t = dict(df.dtypes)[id_col]
    out = map_batches(df.select(id_col, text_col), run,
                      f"id {t}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns over :func:`find_secrets`: counts, hash of the base spans, all spans."""
    from pyspark.sql import functions as F

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    text = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(id_col, *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
