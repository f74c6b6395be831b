"""Restoration of disguised words, calibration, and held-out accuracy on planted documents."""

import itertools
import math
import random
import zlib

import pytest

from yieldloom.llm import toxicity

WORDS = "the of and in to person people thing rather house small never always weather garden table window river".split()
TOXIC = ["idiot", "moron", "pathetic"]


@pytest.fixture(scope="module")
def model():
    counts = {w: 1000 for w in WORDS} | {w: 60 for w in TOXIC}
    return toxicity.CharModel(counts)


@pytest.mark.parametrize(
    "disguise, word",
    [("1d10t", "idiot"), ("idiooot", "idiot"), ("m0r0n", "moron"), ("p@th3t!c", "pathetic"), ("p4thetic", "pathetic"), ("id*ot", "idiot"), ("i-d-i-o-t", "idiot"), ("mmmorooonn", "moron"), ("1d107", "idiot"), ("mmoorroonn", "moron"), ("i*iot", "idiot"), ("morron", "moron"), ("i**ot", "idiot"), ("pa**etic", "pathetic"), ("p*t*e*ic", "pathetic")],
)
def test_restores(model, disguise, word):
    core = toxicity.disguised(disguise)
    assert core and toxicity.restore(core, model) == word


def exhaustive(unit, model, spaced):
    """Best log chance over every path of the lattice, with whole contexts."""
    best = -math.inf
    for path in itertools.product(*toxicity._options(unit, spaced)):
        text = " "
        total = sum(chance for _, chance in path)
        for c in "".join(letters for letters, _ in path) + " ":
            total += model.log(text.split(" ")[-1][-4:] if len(text.split(" ")[-1]) >= 4 else " " + text.split(" ")[-1], c)
            text += c
        best = max(best, total)
    return best


def test_search_is_exhaustive(model):
    rng = random.Random(3)
    for _ in range(150):
        spaced = rng.random() < 0.3
        unit = "".join(rng.choice("idotmrnpahe1034@!xq") for _ in range(rng.randint(1, 4 if spaced else 6)))
        if not spaced and rng.random() < 0.5:
            at = rng.randrange(len(unit))
            unit = unit[:at][:2] + "*" + rng.choice(["", "*"]) + unit[at:][:2]
        assert toxicity.likeliest(unit, model, spaced)[0] == pytest.approx(exhaustive(unit, model, spaced), abs=1e-9), unit


def test_long_unit(model):
    unit = "m0r0n1d10t" * 5000
    assert len(toxicity.restore(unit, model)) > 30_000


def test_common_words_with_doubled_letters_stay():
    assert toxicity.disguised("better,", frozenset(["better"])) is None and toxicity.disguised("bettter", frozenset(["bettter"])) == "bettter"
    assert toxicity.disguised("morron", frozenset(["better"])) == "morron"


def test_two_letters_one_by_one():
    scorer = toxicity.Scorer({"ass ": 0.9}, toxicity.CharModel({"ass": 50, "the": 1000, "a": 1000}))
    assert scorer.raw("you a s s !") == 0.9 and scorer.raw("- - - -") == 0.0 and scorer.raw("x x x") == 0.0


def test_restores_letters_one_by_one(model):
    assert toxicity.restore("i d i o t", model, spaced=True) == "idiot"
    assert toxicity.restore("m 0 r 0 n", model, spaced=True) == "moron"
    assert toxicity.restore("t h e m o r o n", model, spaced=True).replace(" ", "") == "themoron"


def test_leaves_plain_tokens_alone():
    for token in ["the", "the,", "(house)", "1234567890", "!!!", "house!!", "table$$$", "...", ""]:
        assert toxicity.disguised(token) is None


def test_monotone():
    curve = toxicity.monotone([(0.0, 1, 99), (0.5, 5, 5), (0.6, 1, 9), (0.9, 30, 0)])
    assert [r for r, _ in curve] == [0.0, 0.5, 0.9]
    assert [s for _, s in curve] == sorted(s for _, s in curve)


def planted():
    rng = random.Random(9)
    rows, labels = [], []
    hide = lambda w: rng.choice([w, w.upper(), w + "!!", w.replace("o", "0").replace("i", "1"), " ".join(w), w[0] + w[1] * 4 + w[2:]])
    for i in range(1200):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(8, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), hide(rng.choice(TOXIC)) if i > 300 else rng.choice(TOXIC))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = planted()
    more = [(5000, None), (5001, ""), (None, "idiot"), (5002, "x" * 200_000), (5003, "1d10t " * 3000), (0, rows[0][1])]
    df = spark.createDataFrame([(i, t, "toxic", 1.0) for i, t in rows + more], "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame(labels + [(7777, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    got = {}
    for r in toxicity.toxicity(df, marks).collect():
        got.setdefault(r["doc_id"], r)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    truth = {i: t for i, t, _ in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held) and not got[None]["held_out"]
    right = sum(got[i]["predicted"] == truth[i] for i in held)
    assert right / len(held) > 0.97
    assert got[5000]["score"] == got[5001]["score"] < 0.5 and got[5003]["predicted"] == 1 and got[None]["predicted"] == 1


def test_without_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity(df, none).collect()] == [0.0, 0.0]
    assert toxicity.toxicity(df.limit(0), none).count() == 0
