"""The Jaccard join against all pairs, and the word numbers against plain splitting."""

import random
import re

import pytest

from yieldloom import session
from yieldloom.llm import jaccard
from yieldloom.llm.words import shingle_sets, word_numbers


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=75):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def planted(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(12):  # families: chains of small changes, so that the ends may not link
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 9, 30, 120]))]
        for _ in range(rng.choice([1, 2, 6, 40])):
            for _ in range(rng.choice([0, 0, 1, 2])):
                base = list(base)
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append(" ".join(base))
            if rng.random() < 0.3:
                texts.append("\n\t".join(base).upper())
    for _ in range(60):  # many documents with one passage
        own = [rng.choice(vocabulary) for _ in range(rng.choice([2, 6, 12, 60]))]
        texts.append(" ".join(own + passage))
    texts += ["", None, "   \n", "one", "one two", "ONE two"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, rounds", [(1, 4), (2, 0), (3, 1)])
def test_equals_all_pairs(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", rounds)
    rows = planted(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, n int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_nulls_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " b"), (None, text), (7, None), (8, "")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(5, 36, 3), (5, 36, 3), (3, 37, 3), (None, 36, None), (7, 0, 7), (8, 0, 8)], key=str)
    assert jaccard.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_sets_go_to_many_others_and_ids_have_several_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LISTED", 2)
    monkeypatch.setattr(jaccard, "SENT_IDS", 0)
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    rows = planted(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()} == brute(rows)
    # Two texts of one id, each with a near copy elsewhere, and rows that repeat.
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (1, a), (2, a + " x"), (3, b + " y"), (3, b + " y")]
    got = sorted(tuple(r) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 56, 1), (1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (3, 57, 1)]


def test_interim_tables_hold_prefixes_and_not_whole_sets(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    rng = random.Random(8)
    texts = []
    for _ in range(60):  # families of near copies, which are all verified
        base = [f"w{rng.randrange(10**5)}" for _ in range(1500)]
        for _ in range(5):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df).collect()}
    assert found == {i: i // 5 * 5 for i in range(300)}
    written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert written < 0.9 * sum(len(t) for t in texts)  # 1.18 when whole sets were written, 0.67 without


def test_word_numbers():
    texts = ["", "a B  c", "\x0b\x0cA b\tC\n", "É é", "x" * 5000, "nbsp is no space", "a " * 3000]
    raw = [t.encode() for t in texts] + [b"long words " * 300_000]
    numbers, offsets = word_numbers(raw)
    names = {}
    for i, t in enumerate(raw):
        own = words(t.decode())
        part = numbers[offsets[i] : offsets[i + 1]].tolist()
        assert len(part) == len(own)
        for w, x in zip(own, part):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)
    assert [len(s) for s in shingle_sets(raw[:4])] == [0, 1, 1, 1]


def test_hashing_holds_little_beside_the_texts():
    import tracemalloc

    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)).encode() for _ in range(600)]
    tracemalloc.start()
    try:
        made = sum(len(s) for s in shingle_sets(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made == 600 * 396 and peak < 24_000_000  # 37 MB when a megabyte was hashed at once
