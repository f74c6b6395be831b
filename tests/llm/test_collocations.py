"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np

from yieldloom.llm import collocations


def plain(rows, least=10, top=2000, subsumed=50):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for p, a in candidates.items():
        lang, words = p[0], p[1:]
        longer = [b for q, b in candidates.items() if q[0] == lang and len(q) > len(p) and words in [q[i : i + len(words)] for i in range(1, len(q) - len(words) + 1)]]
        if any(100 * b >= subsumed * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, f[lang, *words[:k]], f[lang, *words[k:]], n[lang], score))
    return {(lang, i + 1, r[2].decode(), *r[3:]) for lang, found in out.items() for i, r in enumerate(sorted(found)[:top])}


def corpus(seed=1, docs=900, words=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["New", "York", "City", "naïve", "ÀB", "Ünd"]
    rows = []
    for d in range(docs):
        text = ""
        for _ in range(rng.randrange(0, 60)):
            text += rng.choice(vocabulary[: rng.randrange(2, len(vocabulary) + 1)]) + rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", " ", "\r\n", "!?"])
            if rng.random() < 0.1:
                text += "new York CITY "
        rows.append((rng.choice(["en", "de", None]), text))
    return rows + [("en", None), ("fr", ""), ("fr", " .,; ")] + [("en", "the the the the the cat")] * 40


def found(df, **options):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.collocations(df, **options).collect()}


def test_against_plain_counts(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, next string")
    wanted = plain(rows)
    assert len(wanted) > 50 and found(df.repartition(5)) == wanted
    assert found(df, top=7, subsumed=90, least=5) == plain(rows, 5, 7, 90)


def test_stripes_handed_on_early_and_small_filters(spark, monkeypatch):
    rows = corpus(2)
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "SPLIT_BYTES", 300)
    monkeypatch.setattr(collocations, "FILTER_BITS", 8)
    assert found(df) == plain(rows)


def test_hot_pair_and_long_text(spark):
    rng = random.Random(3)
    long = " ".join(f"of the z{rng.randrange(40)}" for _ in range(60_000))
    rows = [("en", long), ("en", " ".join(["a b"] * 20_000))] + [("en", "of the x")] * 30
    assert found(spark.createDataFrame(rows, "lang string, text string")) == plain(rows)


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**15, 4 * 10**15, 5 * 10**15), (10, 10, 10)], "a long, l long, r long")
    got = [r["s"] for r in df.select(collocations._score("a", "l", "r").alias("s")).collect()]
    assert got == [1000000 * 9 * 10**30 // (20 * 10**30), 1000000]


def test_empty_tables_and_filter(spark):
    assert found(spark.createDataFrame([], "doc_id long, lang string, text string")) == set()
    assert found(spark.createDataFrame([("en", "one two")], "lang string, text string")) == set()
    pairs = spark.createDataFrame([("en", f"a{i}", f"b{i}") for i in range(3000)], "lang string, w1 string, next string")
    assert 2000 < np.unpackbits(collocations.pair_filter(pairs)).sum() <= 3000
