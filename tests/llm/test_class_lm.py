"""Base scores against plain counting, the model's chances, and held-out likelihood."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from yieldloom.llm import class_lm


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w] + [None]


def planted():
    rng = random.Random(2)
    kinds = [[f"{c}{i}{e}" for i in range(40)] for c, e in (("n", "um"), ("v", "et"), ("a", "ic"))]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(rng.randrange(0, 40)):
            words += [rng.choice(kinds[2]), rng.choice(kinds[0]), rng.choice(kinds[1])]
        if rng.random() < 0.2:
            words.append(f"only{rng.randrange(10**6)}um")
        texts.append(" \n".join(words))
    return texts + ["", None, "ÉA Éa éa A a", "x " * 5000, texts[0]]


def counted(rows):
    train = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(tokens(t))
    return train


def test_base_and_held_out(spark):
    rows = list(enumerate(planted())) + [(None, "a b"), (0, "again")]
    df = spark.createDataFrame([(i, t, 1, False) for i, t in rows], "doc_id long, text string, n int, held_out boolean")
    got = sorted(class_lm.scores(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]))
    train = counted(rows)
    n, v = sum(train.values()), len(train)
    want = []
    for i, t in rows:
        own = tokens(t)
        want.append((i is None, i or 0, len(own), sum(train[w] > 0 for w in own), sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own)))
    want.sort()
    assert len(got) == len(want)
    for r, (_, _, size, known, base) in zip(got, want):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (size, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 20 and all(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in held)
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_rare_words_are_joined(spark, monkeypatch):
    rows = list(enumerate(planted()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r["doc_id"]: r for r in class_lm.scores(df).collect()}
    monkeypatch.setattr(class_lm, "HEAD_SHARE", 1e-2)
    monkeypatch.setattr(class_lm, "UNITS", 1)
    some = {r["doc_id"]: r for r in class_lm.scores(df).collect()}
    for i in whole:
        assert some[i]["base_score"] == pytest.approx(whole[i]["base_score"], rel=1e-9)
        assert some[i]["n_known"] == whole[i]["n_known"]


def test_chances_sum_to_one(spark):
    rows = list(enumerate(planted()))
    model, counts = class_lm.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    words = counts.toArrow()
    numbers = words.column("word").to_numpy().view(np.uint64)
    classes = model.classes[model.units(model.look_up(numbers), words.column("ending").to_numpy())]
    n = words.column("n").to_numpy()
    known = np.bincount(classes, weights=10 ** model.emission(n, classes), minlength=len(model.kinds))
    unknown = 10 ** model.emission(np.zeros(len(model.kinds)), np.arange(len(model.kinds)))
    # Classes without words give nothing but the unknown word; the end of a text is the last class's only word.
    assert np.allclose((known + unknown)[:-1], 1)
    assert np.allclose((10**model.transitions).sum(1), 1)


def test_rare_words_get_classes_by_their_neighbours(spark, monkeypatch):
    """Words beyond the core whose endings say nothing, in the head or joined."""
    monkeypatch.setattr(class_lm, "UNITS", 30)
    monkeypatch.setattr(class_lm, "CLASSES", 3)
    rng = random.Random(5)
    kinds = [[f"{c}{rng.randrange(10**6)}x" for _ in range(60)] for c in "nva"]
    chances = [1 / (k + 1) for k in range(60)]
    pick = lambda k: rng.choices(kinds[k], chances)[0]
    texts = [" ".join(pick(k % 3) for k in range(rng.randrange(3), 60)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 == 2]
    totals = []
    for share in (2.0**-19, 1e-2):
        monkeypatch.setattr(class_lm, "HEAD_SHARE", share)
        _, counts = class_lm.fit(df)
        found = {r["word"]: r["cls"] for r in counts.collect()}
        seen = [sorted({w for t in texts for w in t.split()} & set(k)) for k in kinds]
        ids = [np.unique(class_lm.words_and_endings([" ".join(k).encode()])[0].view(np.int64)) for k in seen]
        assert len(found) == sum(len(k) for k in ids) > 150
        most = [Counter(found[w] for w in k.tolist()).most_common(1)[0] for k in ids]
        assert len({c for c, _ in most}) == 3 and sum(n for _, n in most) > 0.95 * len(found)
        scored = {r["doc_id"]: r["score"] for r in class_lm.scores(df).collect()}
        totals.append([scored[i] for i in held])
    assert totals[0] == pytest.approx(totals[1], rel=1e-9)


def test_exchange_finds_classes():
    rng = np.random.default_rng(0)
    truth = np.arange(60) % 3
    bigrams = np.zeros((61, 61))
    line = [60]
    for _ in range(20_000):
        nxt = (truth[line[-1]] + 1) % 3 if line[-1] < 60 else 0
        line.append(int(rng.choice(np.flatnonzero(truth == nxt))) if rng.random() > 0.02 else 60)
    np.add.at(bigrams, (line[:-1], line[1:]), 1)
    found = class_lm.exchange(bigrams, 3)
    assert found[60] == 3 and len({(t, c) for t, c in zip(truth, found)}) == 3


def test_empty_and_no_training(spark):
    schema = "doc_id long, text string"
    assert class_lm.scores(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = class_lm.scores(spark.createDataFrame([(held, "a b")], schema)).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
