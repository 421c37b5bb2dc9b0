"""Secret scan against the base patterns as they stand, and the index against a full scan."""

import hashlib
import random
import re

from billflow.llm import secrets as S

from .conftest import by_id, documents


def base(text):
    out = []
    for r in S.BASE:
        for m in re.finditer(r.pattern, text, re.ASCII):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), [b.kind for b in S.BASE].index(r.kind), r.kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def made_texts(n=400):
    rng = random.Random(1)
    bits = ["password", "PassWD", "secret = ", "api_key:", "apikey='", "TOKEN", " ", "=", ":", "\"", "'", "AKIA",
            "ABCDEFGHIJKLMNOPQRSTU0", "deadbeef" * 3, "é", "😀", "abc123/+", "ghp_" + "a1B2" * 9, "xoxb-1234567890ab",
            "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "https://u:passw0rd@h/", "ſecret=abcdefg"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_matches_a_full_scan(spark):
    texts = made_texts()
    got = by_id(S.secret_digest(S.find_secrets(documents(spark, [(i, t, "s") for i, t in enumerate(texts)]))))
    kinds = [r.kind for r in S.BASE + S.MORE]
    for i, t in enumerate(texts):
        want, row = base(t), got[i][0]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        full = want + [f"{r.kind}:{m.start()}:{m.end()}" for r in S.MORE for m in re.finditer(r.pattern, t, re.ASCII)]
        spans = row.spans.split(",") if row.spans else []
        assert sorted(spans) == sorted(full), t
        key = [(int(x.split(":")[1]), kinds.index(x.split(":")[0])) for x in spans]
        assert key == sorted(key)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(
            sum(x.startswith(k + ":") for x in want) for k in ("assign", "access", "hex"))


def test_queries_hold_for_every_match():
    texts = made_texts(800)
    for rule in S.BASE + S.MORE:
        query = S.trigram_query(rule.pattern)
        for t in texts:
            for m in re.finditer(rule.pattern, t, re.ASCII):
                low = re.sub("[A-Z]", lambda c: c[0].lower(), m[0])
                assert all(any(g in low for g in clause) for clause in query), (rule.kind, m[0])


def test_rules_without_trigrams_scan_fully():
    assert S.trigram_query("[0-9a-f]+") == []
    assert S.trigram_query("a?b?c?") == []
    assert frozenset(["akia"[:3]]) in S.trigram_query("AKIA[A-Z0-9]+")


def test_odd_rows(messy, empty):
    got = by_id(S.secret_digest(S.find_secrets(messy)))
    assert len(got[1]) == 2 and got[2][0].spans == "" and None in got
    assert S.find_secrets(empty).count() == 0


def test_long_logins_and_tokens(spark):
    pat = "github_pat_" + "a1B2c3D4e5F" * 2 + "_" + "x" * 59
    texts = [f"https://x:{pat}@github.com", f"https://{'u' * 200}:{'p' * 5000}@h", f"key {pat}.", f"https://x:abc@h {pat[:-1]}"]
    got = by_id(S.secret_digest(S.find_secrets(documents(spark, [(i, t, "s") for i, t in enumerate(texts)]))))
    assert [got[i][0].spans for i in range(4)] == [
        "url_login:0:104,github_pat:10:103", "url_login:0:5210", "github_pat:4:97", ""]


def test_long_runs_are_linear():
    import time

    start = time.perf_counter()
    S.scan_shard(["https://" + "a" * 1_000_000, "https://a:" + "b" * 1_000_000, "a://b:" * 100_000], S.prepared(S.MORE))
    assert time.perf_counter() - start < 20
