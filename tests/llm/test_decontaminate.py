"""Benchmark passages against all windows, and the promise of the Hamming blocks."""

import random
from collections import Counter

import numpy as np

from yieldloom.llm import decontaminate


def bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def brute(docs, items):
    found = {}
    for d, text in docs:
        w = (text or "").lower().split()
        for i, item in items:
            v = (item or "").lower().split()
            if not v:
                continue
            best = 0
            for s in range(len(w) - len(v) + 1):
                a, b = bag(w[s : s + len(v)]), bag(v)
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.75:
                found[d, i] = best
    return found


def test_equals_all_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(120)]
    own = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(own(n))) for i, n in enumerate([5, 6, 12, 12, 25, 40, 41, 41, 90, 3, 1])]
    items += [(50, ""), (51, None), (52, "la " * 20), (53, items[5][1])]
    docs = []
    for i, (_, item) in enumerate(items):
        words = (item or "").split()
        if len(words) > 20:
            changed = list(words)
            changed[3] = "changed"
            docs += [own(30) + changed + own(9), own(2) + words[:-1] + own(8), words[: len(words) // 2] + own(40)]
        docs += [own(40) + words + own(40), words, [w.upper() for w in words] + own(3)]
    docs += [own(200) for _ in range(10)] + [["la"] * 300]
    rows = [(i, " \n".join(w)) for i, w in enumerate(docs)] + [(900, None), (901, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(df, bench).collect()}
    want = brute(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_blocks_find_all_within_radius():
    rng = random.Random(1)
    items = decontaminate.Items([(0, " ".join(f"x{i}" for i in range(30)))], 75)
    size = items.sizes[30]
    mark = int(size["prints"][0])
    for _ in range(500):
        flipped = mark
        for bit in rng.sample(range(64), rng.randrange(0, 40)):
            flipped ^= 1 << bit
        assert (0 in items.candidates(size, flipped)) == ((flipped ^ mark).bit_count() <= decontaminate.RADIUS)


def test_fingerprints_of_windows_agree():
    rolled = np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64)
    sums = np.concatenate([np.zeros((1, 64), int), np.cumsum(decontaminate._votes(rolled), axis=0, dtype=int)])
    for s in range(0, 400, 37):
        assert int(decontaminate._pack((sums[s + 50] - sums[s])[None, :])[0]) == decontaminate.fingerprint(rolled[s : s + 50])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs, items).count() == 1


def test_many_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 10)
    texts = [" ".join(f"{k}w{i}" for i in range(12)) for k in range(9)]
    docs = spark.createDataFrame([(k, f"x y {t} z") for k, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(k, k) for k in range(9)]
