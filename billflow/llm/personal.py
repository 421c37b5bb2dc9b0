"""Personal data: exact base forms, and a character BiLSTM-CRF for what they miss.

The base forms (email, ip, card, phone) are matched over every whole text. The
model is a bidirectional LSTM over character classes with CRF transitions,
trained in numpy from labelled spans: the base spans of a bounded sample of
documents, and rewritten forms of them (other separators, no plus sign, spaced
addresses) that the base forms miss. A text is covered by overlapping windows,
decoded by Viterbi.

Windows are reconciled globally. A window owns the spans whose first trigger
character (a digit or @) lies in its middle part, the middle parts tile the text,
and every span that can be accepted has a trigger; so each span comes from one
window, and a window without a trigger in its middle owns nothing and need not be
run. Where a span that a window owns comes near an edge of it that is no edge of
the text, the window is widened on that side and decoded again, until the span
lies inside with context on both sides, however long it is; windows that meet as
they widen become one stretch. What the windows own is checked (an
address has its parts, a card its check sum ...) and kept where it touches no
base span and no earlier span of the model. Base spans always stay.

Defined results: a null text counts as empty; an empty text or table gives no
spans; repeated rows each get theirs; a sample without spans gives no model, and
the base spans alone.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ["email", "ip", "card", "phone"]
WINDOW, MARGIN, CONTEXT, HIDDEN = 112, 40, 16, 12
STRIDE = WINDOW - 2 * MARGIN
SAMPLE_DOCS, SAMPLE_SPANS, STEPS, BATCH = 20_000, 2_000, 240, 48

# The base forms. The parts before @ are read backwards from it.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base form that pass its check."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if not TRIGGER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


# --- characters and tags -----------------------------------------------------

_SIGNS = "@.+-()_%:/ \n,;=#"
_CLASSES = 5 + len(_SIGNS)  # pad, digit, lower, upper, other, then the signs


def _class_table() -> np.ndarray:
    t = np.full(65536, 4, np.int64)
    for c in range(128):
        ch = chr(c)
        t[c] = 1 if ch.isdigit() else 2 if ch.islower() else 3 if ch.isupper() else 4
        if ch in _SIGNS:
            t[c] = 5 + _SIGNS.index(ch)
    t[0] = 4
    return t


_TABLE = _class_table()
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def classes(text: str) -> np.ndarray:
    return _TABLE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 65535)]


def tags_of(spans: list[Span], n: int) -> np.ndarray:
    y = np.zeros(n, np.int64)
    for k, s, e in spans:
        y[max(s, 0):e] = 2 + 2 * k  # a span that began before the window has no begin
        if s >= 0:
            y[s] = 1 + 2 * k
    return y


def spans_of(tags: np.ndarray) -> list[Span]:
    out: list[Span] = []
    start, kind = 0, -1
    for i, t in enumerate([*tags.tolist(), 0]):
        k = (t - 1) // 2 if t else -1
        if kind >= 0 and (k != kind or t % 2 == 1):
            out.append((kind, start, i))
            kind = -1
        if t and kind < 0:
            start, kind = i, k
    return out


# --- the model ---------------------------------------------------------------

def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_weights(rng: np.random.Generator, h: int = HIDDEN) -> dict[str, np.ndarray]:
    """Input table, recurrence (both for two directions), output layer, CRF transitions and start scores."""
    w = {"x": rng.normal(0, 0.3, (2, _CLASSES, 4 * h)), "r": rng.normal(0, 0.3, (2, h, 4 * h)),
         "o": rng.normal(0, 0.3, (2 * h, TAGS)), "b": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS)),
         "s": np.zeros(TAGS)}
    w["x"][:, :, h:2 * h] += 1.0  # forget gates open at first
    return {k: v.astype(np.float32) for k, v in w.items()}


def _lstm(w: dict, c: np.ndarray, keep: bool = False):
    """Hidden states (n, T, 2h) of class rows c (n, T); with ``keep``, what the backward pass needs."""
    n, length = c.shape
    h = w["r"].shape[1]
    both = np.stack([c, c[:, ::-1]])
    state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    out, trace = np.empty((2, length, n, h), np.float32), []
    for i in range(length):
        z = np.stack([w["x"][0][both[0, :, i]], w["x"][1][both[1, :, i]]]) + state @ w["r"]
        g = _sigmoid(z[..., :3 * h])
        a = np.tanh(z[..., 3 * h:])
        before, prev = cell, state
        cell = g[..., h:2 * h] * cell + g[..., :h] * a
        tc = np.tanh(cell)
        state = g[..., 2 * h:] * tc
        out[:, i] = state
        if keep:
            trace.append((g, a, before, prev, tc))
    hidden = np.concatenate([out[0].transpose(1, 0, 2), out[1, ::-1].transpose(1, 0, 2)], axis=2)
    return (hidden, both, trace) if keep else hidden


def _logsum(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def _crf(w: dict, e: np.ndarray, y: np.ndarray):
    """Mean negative log likelihood and its gradients for emissions e (n, T, K) and tags y (n, T)."""
    n, length, k = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = w["s"] + e[:, 0]
    for i in range(1, length):
        alpha[:, i] = _logsum(alpha[:, i - 1, :, None] + w["t"], 1) + e[:, i]
    for i in range(length - 2, -1, -1):
        beta[:, i] = _logsum(w["t"] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
    z = _logsum(alpha[:, -1], 1)
    rows = np.arange(n)
    gold = w["s"][y[:, 0]] + e[rows[:, None], np.arange(length), y].sum(1) + w["t"][y[:, :-1], y[:, 1:]].sum(1)
    de = np.exp(alpha + beta - z[:, None, None])
    ds = de[:, 0].sum(0)
    dt = np.zeros_like(w["t"])
    for i in range(1, length):
        dt += np.exp(alpha[:, i - 1, :, None] + w["t"] + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]).sum(0)
    de[rows[:, None], np.arange(length), y] -= 1
    np.subtract.at(ds, y[:, 0], 1)
    np.subtract.at(dt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    return float((z - gold).mean()), de / n, dt / n, ds / n


def _gradients(w: dict, c: np.ndarray, y: np.ndarray):
    hidden, both, trace = _lstm(w, c, keep=True)
    loss, de, dt, ds = _crf(w, hidden @ w["o"] + w["b"], y)
    h = w["r"].shape[1]
    grads = {"o": np.einsum("nth,ntk->hk", hidden, de), "b": de.sum((0, 1)), "t": dt, "s": ds,
             "x": np.zeros_like(w["x"]), "r": np.zeros_like(w["r"])}
    back = de @ w["o"].T
    dout = np.stack([back[:, :, :h].transpose(1, 0, 2), back[:, ::-1, h:].transpose(1, 0, 2)])
    dstate, dcell = np.zeros_like(trace[0][2]), np.zeros_like(trace[0][2])
    for i in range(len(trace) - 1, -1, -1):
        g, a, before, prev, tc = trace[i]
        dstate = dstate + dout[:, i]
        dcell = dcell + dstate * g[..., 2 * h:] * (1 - tc * tc)
        dg = np.concatenate([dcell * a, dcell * before, dstate * tc], axis=2)
        dz = np.concatenate([dg * g * (1 - g), dcell * g[..., :h] * (1 - a * a)], axis=2)
        for d in (0, 1):
            np.add.at(grads["x"][d], both[d, :, i], dz[d])
        grads["r"] += prev.transpose(0, 2, 1) @ dz
        dstate = dz @ w["r"].transpose(0, 2, 1)
        dcell = dcell * g[..., h:2 * h]
    return loss, grads


def train(rows: list[tuple[str, list[Span]]], steps: int = STEPS, batch: int = BATCH, seed: int = 10) -> dict | None:
    """Weights from (window text, spans), by Adam; None without any span."""
    if not any(s for _, s in rows):
        return None
    rng = np.random.default_rng(seed)
    c = np.zeros((len(rows), WINDOW), np.int64)
    y = np.zeros((len(rows), WINDOW), np.int64)
    for i, (text, spans) in enumerate(rows):
        c[i, :len(text)] = classes(text)[:WINDOW]
        y[i, :len(text)] = tags_of(spans, len(text))[:WINDOW]
    w = new_weights(rng)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        at = rng.integers(0, len(rows), min(batch, len(rows)))
        _, g = _gradients(w, c[at], y[at])
        rate = 0.02 * (1 - 0.9 * step / steps)
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k in w:
            x = g[k] * min(1.0, 5.0 / (size + 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * x
            m2[k] = 0.99 * m2[k] + 0.01 * x * x
            w[k] = (w[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
                    ).astype(np.float32)
    return w


def decode(w: dict, c: np.ndarray) -> np.ndarray:
    """Viterbi tags (n, T) of class rows."""
    e = _lstm(w, c) @ w["o"] + w["b"]
    n, length, k = e.shape
    score, back = w["s"] + e[:, 0], np.empty((n, length, k), np.int8)
    for i in range(1, length):
        s = score[:, :, None] + w["t"]
        back[:, i] = s.argmax(1)
        score = s.max(1) + e[:, i]
    tags = np.empty((n, length), np.int64)
    tags[:, -1] = score.argmax(1)
    for i in range(length - 1, 0, -1):
        tags[:, i - 1] = back[np.arange(n), i, tags[:, i]]
    return tags


# --- labelled spans ----------------------------------------------------------

def rewritten(kind: int, form: str, rng: np.random.Generator) -> str:
    """A form of the same datum that the base forms miss, or the form itself."""
    pick = rng.integers(0, 4)
    if pick == 0:
        return form
    d = _digits(form)
    if kind == 0 and form.count("@") == 1:
        a, b = form.split("@")
        return [f"{a} @ {b}", f"{a}@ {b}", f"{a} @{b}"][pick - 1]
    if kind == 1:
        return [form.replace(".", " . "), form.replace(".", ". "), form.replace(".", " .")][pick - 1]
    if kind == 2:
        sep = [".", "/", "  "][pick - 1]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == 3 and len(d) >= 10:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{d[:-10]} {a} {b} {c}"][pick - 1]
    return form


def shortened(form: str) -> str:
    """The form with each part (before and from the @) over two windows cut in its middle: no window shows more."""
    at = form.find("@")
    parts = [form[:at], form[at:]] if at >= 0 else [form]
    return "".join(p if len(p) <= 2 * WINDOW else p[:WINDOW] + p[-WINDOW:] for p in parts)


def labelled(rows: list[tuple[str, int, str, str]], seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Training windows from (text before, kind or -1, form, text after): as found, and rewritten.

    A form over half a window gives windows over all its length, each with its part of the span.
    """
    rng = np.random.default_rng(seed)
    out = []
    for left, kind, form, right in rows:
        for f in ([form] if kind < 0 else [form, rewritten(kind, form, rng)]):
            shift = int(rng.integers(MARGIN // 2, WINDOW // 2))
            head = left[-shift:] if left else ""
            if len(f) > WINDOW // 2:
                whole, s, e = head + f + right, len(head), len(head) + len(f)
                for lo in range(0, e, WINDOW // 2):
                    text = whole[lo:lo + WINDOW]
                    spans = [x for x in base_spans(text) if x[1] >= e - lo or x[2] <= s - lo]
                    out.append((text, sorted([(kind, s - lo, e - lo), *spans], key=lambda x: x[1])))
                continue
            text = (head + f + right)[:WINDOW]
            s, e = len(head), min(len(head) + len(f), WINDOW)
            spans = [(kind, s, e)] if kind >= 0 and e == len(head) + len(f) else []
            # other data around the datum carry their labels too
            spans += [x for x in base_spans(text) if x[1] >= e or x[2] <= s]
            out.append((text, sorted(spans, key=lambda x: x[1])))
    return out


def fit(df: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_spans: int = SAMPLE_SPANS,
        steps: int = STEPS) -> dict | None:
    """Train from the base spans (and digits that are none) of about ``sample_docs`` documents, by hash.

    At most ``sample_spans`` snippets of bounded length (:func:`shortened`) reach the driver.
    """
    total = df.count()
    share = min(1.0, sample_docs / max(1, total))
    texts = df.select(F.col(text_col).alias("t")).filter("t is not null")
    if share < 1:
        texts = texts.filter((F.conv(F.substring(F.md5("t"), 1, 8), 16, 10).cast("double") / 2.0 ** 32) < share)

    def snippets(cols):
        left, kind, form, right = [], [], [], []
        for t in cols[0]:
            spans = base_spans(t)
            found = list(spans)
            free = (m for m in TRIGGER.finditer(t) if not any(s <= m.start() < e for _, s, e in spans))
            found += [(-1, m.start(), m.end()) for m, _ in zip(free, range(2))]
            for k, s, e in found:
                left.append(t[max(0, s - WINDOW):s])
                kind.append(k)
                form.append(shortened(t[s:e]))
                right.append(t[e:e + WINDOW])
        yield {"l": left, "k": kind, "f": form, "r": right}

    rows = (map_batches(texts, snippets, "l string, k int, f string, r string")
            .withColumn("u", F.md5(F.concat_ws("|", "l", "k", "f", "r"))).dropDuplicates(["u"])
            .orderBy("u").limit(sample_spans).collect())
    rows = sorted(rows, key=lambda r: r.u)
    return train(labelled([(r.l, r.k, r.f, r.r) for r in rows]), steps)


# --- windows over whole texts ------------------------------------------------

def windows(text: str, prune: bool = True) -> list[int]:
    """Starts of the windows of a text; with ``prune``, those whose middle holds a trigger."""
    last = max(0, -(-len(text) // STRIDE))
    if not prune:
        return [i * STRIDE - MARGIN for i in range(last)]
    return [i * STRIDE - MARGIN for i in sorted({m.start() // STRIDE for m in TRIGGER.finditer(text)})]


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the model found can be a datum of its kind."""
    d = _digits(text)
    if not text or text != text.strip() or "\n" in text:
        return False
    if kind == 0:
        a, at, b = text.partition("@")
        b = b.strip()
        return bool(at and a.strip() and re.fullmatch(r"[^\s@]+", a.strip()) and re.fullmatch(r"[^\s@.]+(\.[^\s@.]+)+", b))
    if kind == 1:
        parts = re.fullmatch(r"([0-9]{1,3}) ?\. ?([0-9]{1,3}) ?\. ?([0-9]{1,3}) ?\. ?([0-9]{1,3})", text)
        return bool(parts) and all(int(p) <= 255 for p in parts.groups())
    if kind == 2:
        return 14 <= len(d) <= 19 and luhn(d) and re.fullmatch(r"[0-9]+(?:[ ./-]{1,2}[0-9]+)+", text) is not None
    return 10 <= len(d) <= 15 and re.fullmatch(r"[(+]?[0-9][0-9 ().-]*[0-9]", text) is not None and len(d) < len(text)


def _alone(text: str, s: int, e: int) -> bool:
    """No letter or digit touches the span."""
    return not (s and text[s - 1].isalnum() and text[s].isalnum()) and not (
        e < len(text) and text[e].isalnum() and text[e - 1].isalnum())


def hopeless(kind: int, piece: str) -> bool:
    """Whether no datum of the kind can hold this piece, whatever stands around it."""
    if "\n" in piece:
        return True
    return piece.count("@") > 1 if kind == 0 else len(_digits(piece)) > (12, 19, 15)[kind - 1]


def _owned(text: str, tags: np.ndarray, lo: int, owns: frozenset[int]) -> list[Span]:
    """The tagged spans of a stretch that starts at ``lo`` whose first trigger lies in one of its middle parts."""
    out = []
    for kind, a, b in spans_of(tags):
        a, b = a + lo, b + lo
        if a < 0 or b > len(text):
            continue
        m = TRIGGER.search(text, a, b)
        if m and m.start() // STRIDE in owns:
            out.append((kind, a, b))
    return out


def _merged(stretches: list[tuple[int, int, int, frozenset[int]]]) -> list[tuple[int, int, int, frozenset[int]]]:
    """Stretches (text, start, end, owned middle parts) with those of one text that overlap made one."""
    out: list[tuple[int, int, int, frozenset[int]]] = []
    for d, lo, hi, owns in sorted(stretches, key=lambda x: x[:3]):
        if out and out[-1][0] == d and lo < out[-1][2]:
            _, lo, before, more = out.pop()
            hi, owns = max(hi, before), owns | more
        out.append((d, lo, hi, owns))
    return out


def model_spans(w: dict, texts: list[str], base: list[list[Span]], prune: bool = True,
                block: int = 1024) -> list[list[Span]]:
    """What the model adds to each text's base spans, reconciled over its windows."""
    todo = [(d, s, s + WINDOW, frozenset([(s + MARGIN) // STRIDE])) for d, t in enumerate(texts) for s in windows(t, prune)]
    found: list[list[Span]] = [[] for _ in texts]
    while todo:
        todo.sort(key=lambda x: (x[2] - x[1], x[0], x[1]))
        wider, at = [], 0
        while at < len(todo):
            # rows of one length, so that no row is padded for another
            size = todo[at][2] - todo[at][1]
            most = at + max(1, block * WINDOW // size)
            part = [x for x in todo[at:most] if x[2] - x[1] == size]
            at += len(part)
            c = np.zeros((len(part), size), np.int64)
            for i, (d, lo, hi, _) in enumerate(part):
                piece = classes(texts[d][max(0, lo):hi])
                c[i, max(0, -lo):max(0, -lo) + len(piece)] = piece
            tags = decode(w, c)
            for i in np.flatnonzero(tags.any(axis=1)).tolist():
                d, lo, hi, owns = part[i]
                text, mine = texts[d], _owned(texts[d], tags[i], part[i][1], part[i][3])
                open_ = [(a, b) for kind, a, b in mine if not hopeless(kind, text[a:b])]
                left = lo > 0 and any(a - lo < CONTEXT for a, _ in open_)
                right = hi < len(text) and any(hi - b < CONTEXT for _, b in open_)
                if left or right:
                    wider.append((d, lo - left * size, hi + right * size, owns))
                else:
                    found[d] += [(k, a, b) for k, a, b in mine if plausible(k, text[a:b]) and _alone(text, a, b)]
        todo = _merged(wider)
    out = []
    for mine, more in zip(base, found):
        taken = sorted((s, e) for _, s, e in mine)
        good: list[Span] = []
        for kind, a, b in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
            if all(b <= s or e <= a for s, e in taken):
                good.append((kind, a, b))
                taken.append((a, b))
        out.append(good)
    return out


def find_personal(df: DataFrame, weights: dict | None, id_col: str = "doc_id", text_col: str = "text",
                  prune: bool = True) -> DataFrame:
    """One row per document: id, spans (array of kind, start, end, base), by start, then kind."""

    def run(cols):
        texts = [t or "" for t in cols[1]]
        base = [base_spans(t) if "@" in t or TRIGGER.search(t) else [] for t in texts]
        more = model_spans(weights, texts, base, prune) if weights else [[] for _ in texts]
        yield {"id": cols[0], "spans": [
            [{"kind": KINDS[k], "start": s, "end": e, "base": b}
             for s, k, e, b in sorted([(s, k, e, True) for k, s, e in x] + [(s, k, e, False) for k, s, e in y])]
            for x, y in zip(base, more)]}

    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col), run,
                       f"id {t}, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
                       ).withColumnRenamed("id", id_col)


def personal_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns over :func:`find_personal`: base counts, hash of the base spans, all spans."""
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
