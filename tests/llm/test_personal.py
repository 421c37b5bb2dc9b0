"""Base spans against the patterns; the model's windows; gradients against differences."""

import hashlib
import re

import numpy as np
import pytest

from billflow.llm import personal as P

from .conftest import by_id, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(x):
    n = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(x)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(x) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(x) if 14 <= len(n(m[0])) <= 19 and luhn(n(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(x) if 10 <= len(n(m[0])) <= 15]
    return sorted(out)


def test_base_spans():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("a1.@+ -()9%é٣0")) for _ in range(50)) for _ in range(3000)]
    texts += ["1.2.3.4.5.6.7.8", "a@b@c.d", "x@@y.z", "@a.b", "a@b.c@d.e", "1.2.3.400 1.2.3.4", "+1 (988) 555-2485.",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "x" * 50_000 + "@", "1" * 50_000, "0001.1.1.1", "+" * 2000]
    for x in texts:
        assert [(s, k, e) for k, s, e in P.base_spans(x)] == brute(x), x[:60]


def test_gradients():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in P.new_weights(rng, 3).items()}
    c, y = rng.integers(0, P._CLASSES, (2, 6)), rng.integers(0, P.TAGS, (2, 6))
    _, g = P._gradients({k: v.astype(np.float32) for k, v in w.items()}, c, y)
    for k in w:
        at = tuple(rng.integers(0, s) for s in w[k].shape) if k != "x" else (0, int(c[0, 0]), 1)
        loss = []
        for step in (1e-2, -1e-2):
            v = {n: a.astype(np.float32) for n, a in w.items()}
            v[k][at] += step
            loss.append(P._gradients(v, c, y)[0])
        assert abs((loss[0] - loss[1]) / 2e-2 - g[k][at]) < 2e-2, k


@pytest.fixture(scope="module")
def weights(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), sample_docs=10_000)


def test_learns_other_forms(weights):
    forms = ["call me (988) 555-2485 now please", "write to hans.meier @ mail3.example.com today",
             "the ip 10 . 20 . 30 . 40 here", "und 988-555-2485 das"]
    got = [P.model_spans(weights, [x], [P.base_spans(x)])[0] for x in forms]
    assert sum(bool(x) for x in got) >= 3


def test_skipped_windows_own_nothing(spark, weights):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [t for t in texts if P.TRIGGER.search(t)][:25] + ["call (988) 555-2485 " * 20, "a" * 300, "", "7", "@"]
    base = [P.base_spans(t) for t in texts]
    assert P.model_spans(weights, texts, base) == P.model_spans(weights, texts, base, prune=False)


LONG = "maria.gonzalez7 @ translational-medicine.university-hospital-zurich.example"


def test_long_spans_come_whole_at_every_offset(monkeypatch):
    signs = {c: ch for ch in "a1.-@ " for c in P.classes(ch).tolist()}

    def tagger(_, c):  # knows spaced addresses, also where an edge of its window cuts them
        y = np.zeros(c.shape, np.int64)
        for i, row in enumerate(c.tolist()):
            for m in re.finditer(r"[a1.-]+ @ [a1.-]+|^(?: ?@ )?[a1.-]*[.-][a1.-]+|[a1.-]*1 ?@? ?$", "".join(signs.get(x, "_") for x in row)):
                y[i, m.start():m.end()] = 2
                y[i, m.start()] = 1
        return y

    monkeypatch.setattr(P, "decode", tagger)
    for form in (LONG, "jo7 @ " + "sub-domain." * 200 + "example", "x" * 90 + "7 @ b.example", "x" * 300 + " @ b.example"):
        for at in range(100, 100 + 2 * P.STRIDE):
            text = "word " * 20 + "_" * (at - 100) + " " + form + " and so on" * 20
            s = text.index(form)
            assert P.model_spans({}, [text, ""], [[], []]) == [[(0, s, s + len(form))], []], (form[:20], at)


def test_learns_long_forms(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghinorstu"), rng.integers(3, 12)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{prose(30)} {word()}.{word()}{i % 90}@{'-'.join(word() for _ in range(4))}."
                f"{'-'.join(word() for _ in range(4))}.example {prose(30)}", "s") for i in range(400)]
    w = P.fit(documents(spark, rows))
    found = 0
    for at in range(P.STRIDE):
        text = prose(40)[-100 - at:] + " " + LONG + " " + prose(30)
        got, = P.model_spans(w, [text], [P.base_spans(text)])
        found += any(text[s:e] == LONG for _, s, e in got)
        assert not any(text[s:e] in LONG and text[s:e] != LONG for _, s, e in got), at
    assert found > 0.9 * P.STRIDE


def test_digest(spark, weights):
    text = "mail a.b@c.de, ip 1.2.3.4; card 4111 1111 1111 1111 and +1 (988) 555-2485!"
    r, = P.personal_digest(P.find_personal(documents(spark, [(1, text, "s")]), weights)).collect()
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    want = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in brute(text))
    assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert set(want.split(",")) <= set(r.spans.split(","))


def test_odd_rows(messy, empty, weights):
    got = by_id(P.personal_digest(P.find_personal(messy, weights)))
    assert got[2][0].spans == "" and len(got[1]) == 2 and None in got
    assert P.find_personal(empty, weights).count() == 0
    assert P.fit(empty) is None and P.find_personal(messy, None).count() == 12
