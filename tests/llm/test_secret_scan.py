"""Base spans against plain patterns, automata on credentials with a format, and redaction."""

import hashlib
import random
import re

from yieldloom.llm import secret_scan

PATTERNS = [
    (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]


def plain(text):
    spans = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if ok(m)]
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def texts():
    rng = random.Random(4)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    upper = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    own = [None, "", "plain prose without any of it", "é token = \"" + hexed(40) + "\" ü", "pasſword=abcdefgh12345", "toKen: abcdefgh12345"]
    own += [f"api_key:'{hexed(8)}' APIKEY={hexed(7)} Secret = token=abcdefgh12", "AKIA" + upper(12) + " AKIA" + upper(11), hexed(31) + " " + hexed(32) + " " + hexed(300)]
    own += [f"words {i} token = \"{hexed(40)}\" more AKIA{upper(16)}" for i in range(120)]
    own += [f"naked {upper(4)}-7 value {'AKIB' + upper(16)} in text", "a" * 100_000, "https://example.org/some/long/path-with-words-2024"]
    own += [f"moved {hexed(12)}{hexed(19)} only"]  # 31 hexadecimal digits: no base pattern has it
    return own


def test_base_spans_and_formats(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, "token=abcdefgh", 1)], "doc_id long, text string, spans int")
    got = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.found_secrets(df)).collect()}
    assert len(got) == len(rows) + 1
    for i, text in rows:
        want = plain(text)
        base = ",".join(s for s in got[i]["spans"].split(",") if not s.startswith("format"))
        assert base == want, text
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert got[i]["n_hex"] == want.count("hex:")
    assert got[len(rows) - 1]["n_format"] == 1, "as likely as the labelled tokens"
    assert got[2]["n_format"] == 0 and got[len(rows) - 2]["n_format"] == 0


def test_merging_keeps_counts_and_loops():
    rng = random.Random(8)
    values = ["".join(rng.choice("a0") for _ in range(20)) for _ in range(2000)]
    prefixes, tails = {}, {}
    for v in values:
        for k in range(min(len(v), secret_scan.DEPTH + 1) + 1):
            n, e = prefixes.get(v[:k], (0, 0))
            prefixes[v[:k]] = (n + 1, e + (k == len(v)))
        for k in range(len(v)):
            t = tails.setdefault(v[k], {})
            nxt = v[k + 1] if k + 1 < len(v) else secret_scan.END
            t[nxt] = t.get(nxt, 0) + 1
    automaton = secret_scan.Automaton(prefixes, tails)
    assert len(automaton.moves) < 40, "the tree has collapsed"
    assert automaton.score("f3a91c04be72d6508a1f") > automaton.score("hello-world-to-you-all") + 0.3


def test_redaction(spark):
    rows = [(1, "x", "a token = \"0123456789abcdef0123456789abcdef\" b"), (2, None, None), (3, "y", "clean"), (4, "z", "")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r for r in secret_scan.redact(df).collect()}
    assert got[1]["text"] == "a [SECRET]\" b" and got[2]["text"] is None and got[3]["text"] == "clean" and got[4]["text"] == ""
    assert secret_scan.redact(df.limit(0)).count() == 0
    assert secret_scan.digest(secret_scan.found_secrets(df.limit(0))).count() == 0
