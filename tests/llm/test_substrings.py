"""Repeated passages against a plain search for common runs of words."""

import random

from yieldloom.llm import substrings


def longest_common(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = row[j] + 1
                best = max(best, new[j + 1])
        row = new
    return best


def planted():
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(2000)]
    own = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [own(n) for n in (50, 51, 60, 90, 200, 30, 45, 49)]
    docs = []
    for _ in range(3):
        for p in passages:
            docs.append(own(rng.randrange(0, 80)) + p + own(rng.randrange(0, 80)))
    docs += [own(100) for _ in range(20)] + [own(5) * 60, own(5) * 60, []]
    rng.shuffle(docs)
    return docs


def test_finds_long_passages_only(spark):
    docs = planted()
    sep = [" ", "\n", " \t "]
    df = spark.createDataFrame([(i, sep[i % 3].join(w), "x") for i, w in enumerate(docs)] + [(500, None, "x"), (None, " ".join(docs[0]), "x")], "doc_id long, text string, start string")
    found = substrings.repeated_passages(df).collect()
    wanted = {i for i, a in enumerate(docs) if any(longest_common(a, b) >= 50 for j, b in enumerate(docs) if i != j)}
    assert {r["doc_id"] for r in found} == wanted
    for r in found:
        assert r["n_words"] >= 50 and longest_common(docs[r["doc_id"]][r["start_word"] : r["start_word"] + r["n_words"]], docs[r["other"]]) >= 40


def test_cuts_what_others_keep(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(1, f"a b {passage} c d"), (2, f"x {passage}\n y"), (3, "alone"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in substrings.without_repeats(df, substrings.repeated_passages(df)).collect()}
    assert cut[1] == rows[0][1] and cut[3] == "alone" and cut[4] is None
    assert len(cut[2].split()) < 30 and "x" in cut[2].split() and "y" in cut[2].split()


def test_empty_table(spark):
    assert substrings.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whoever_else_holds_the_parts(spark):
    rng = random.Random(9)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs, wanted = {}, {}
    for at in range(0, 3000, 1000):
        p = own(60)
        for other, part in ((1, p[:30]), (900, p[:30]), (2, p[30:]), (901, p[30:])):
            docs[at + other] = own(20) + part + own(20)
        docs[at + 50], docs[at + 60] = own(13) + p + own(8), own(31) + p + own(5)
        wanted |= {at + 50: (13, 60, at + 60, True), at + 60: (31, 60, at + 50, False)}
    # Passages in one document twice, and behind a text's begin and before its end.
    p = own(50)
    docs |= {5000: p + own(3) + p, 5001: own(4) + p, 5002: own(70)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    found = [(r["doc_id"], tuple(r)[1:]) for r in substrings.repeated_passages(df).collect()]
    assert sorted(found) == sorted([*wanted.items(), (5000, (0, 50, 5001, True)), (5000, (53, 50, 5001, True)), (5001, (4, 50, 5000, False))])


def test_every_shared_window_is_found(spark):
    rng = random.Random(11)
    docs = []
    for _ in range(150):
        p = [rng.choice("abcdefghijklmnopq") for _ in range(50)]
        docs += [[rng.choice("rstuv") for _ in range(rng.randrange(12))] + p + [rng.choice("wxyz") for _ in range(rng.randrange(12))] for _ in range(2)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {(r["doc_id"], r["start_word"] + k) for r in substrings.repeated_passages(df).collect() for k in range(r["n_words"] - 49)}
    holders = {}
    for i, w in enumerate(docs):
        for k in range(len(w) - 49):
            holders.setdefault(tuple(w[k : k + 50]), []).append((i, k))
    assert got == {place for places in holders.values() if len({i for i, _ in places}) > 1 for place in places}
