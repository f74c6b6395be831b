"""Packing: ids as the tokenizer gives them, capacities, places without gaps, and how many sequences are needed."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from yieldloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, tokenizer=Tokenizer.from_file(PATH)):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, capacities=packing.Capacities()):
    own = defaultdict(list)
    for r in rows:
        own[r["doc_id"]].append(r)
    assert set(own) == set(docs)
    for doc_id, parts in own.items():
        parts.sort(key=lambda r: r["piece"])
        ids = ids_of(docs[doc_id])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // capacities.longest)))
        at = 0
        for r in parts:
            assert r["start"] == at and r["length"] == min(capacities.longest, len(ids) - at)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        limits = capacities.vector
        assert end <= limits[0] and len(parts) <= limits[1] and sum(n * n for _, n in parts) <= limits[2]
    return len(sequences)


def texts():
    rng = random.Random(2)
    words = ["Hello", "naïve", "don't", "x1y2", "ΑΣ", "é", "́a", "日本語", "<|endoftext|>", "a b", "\x1c", "...", "🙂", "ﬁ", "I'll", "W" * 300]
    docs = {i: "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", " ", " \x0b"]) for _ in range(rng.randrange(0, 900))) for i in range(60)}
    return docs | {100: "", 101: None, 102: " \n ", 103: "word " * 30_000, 104: "z" * 5000}


def test_ids_and_places(spark):
    docs = texts()
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs.items()], "doc_id long, text string, length int, sequence_id string")
    rows = packing.packed(df.repartition(4), PATH).collect()
    needed = check(rows, docs)
    assert needed <= -(-sum(r["length"] for r in rows) // 2048) + 4  # few pieces are short


def test_every_constraint_binds(spark):
    docs = texts()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for capacities in (packing.Capacities(512, 3), packing.Capacities(512, None, 40_000), packing.Capacities(300, 2, 50_000)):
        check(packing.packed(df, PATH, capacities).collect(), docs, capacities)


def test_parts_of_long_texts_and_forgetting(spark, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "LONGEST_CHUNK", 4)
    encoder = packing.Encoder(PATH)
    docs = [t for t in texts().values()]
    assert [list(x) for x in encoder.texts([(t or "").encode() for t in docs], 0)] == [ids_of(t) for t in docs]
    long = "Some words, and more of them.\n" * 60_000
    assert list(next(encoder.texts([long.encode()], 0))) == ids_of(long)


def test_words_of_latin_letters():
    letters = [chr(c) for c in range(256) if chr(c).isalpha()]
    words = [a + b + tail for a in letters for b in "aZéÿßÅ" for tail in ("", ".", "),", "'s", "$$$", "\u0301", "…")]
    encoder = packing.Encoder(PATH)
    assert [list(x) for x in encoder.texts([w.encode() for w in words], 0)] == [ids_of(w) for w in words]


def test_common_length_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 7)
    rows = [(None, "one two three")] * 50 + [(1, "one two three")] * 30 + [(i, "four") for i in range(40)]
    out = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), PATH, packing.Capacities(10)).collect()
    assert len(out) == 120 and len({(r["sequence_id"], r["offset"]) for r in out}) == 120
    assert max(r["offset"] + r["length"] for r in out) <= 10
    assert len({r["sequence_id"] for r in out}) == 40


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_few_sequences(seed):
    rng = random.Random(seed)
    lengths = [min(2048, int(rng.lognormvariate(5, 1.3)) + 1) for _ in range(3000)]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.fillings(histogram, packing.Capacities())
    used = defaultdict(int)
    for f in plan:
        assert sum(n * k for n, k in f.uses) <= 2048
        for n, k in f.uses:
            used[n] += k * f.copies
    assert used == histogram
    assert sum(f.copies for f in plan) <= -(-sum(lengths) // 2048) + 1


def test_few_sequences_against_best():
    """Small cases against the best packing, found by trying all."""

    def best(items, room):
        least = [len(items)]

        def place(i, bins):
            if len(bins) >= least[0]:
                return
            if i == len(items):
                least[0] = len(bins)
                return
            for b in range(len(bins)):
                if bins[b] + items[i] <= room and bins[b] not in bins[:b]:
                    place(i + 1, bins[:b] + [bins[b] + items[i]] + bins[b + 1 :])
            place(i + 1, [*bins, items[i]])

        place(0, [])
        return least[0]

    rng = random.Random(8)
    more = 0
    for _ in range(40):
        items = sorted((rng.randrange(1, 14) for _ in range(10)), reverse=True)
        got = sum(f.copies for f in packing.fillings({n: items.count(n) for n in set(items)}, packing.Capacities(20)))
        more += got - best(items, 20)
    assert more <= 2


def test_chunks_are_numbered_once_and_kept_for_later_tasks():
    encoder = packing.worker_encoder(PATH)
    assert packing.worker_encoder(PATH) is encoder
    text = "Hello world, (naïve) hello... Ünder x1y2 " + "W" * 300 + " HELLO! don't"
    for _ in range(2):
        assert [x.tolist() for x in encoder.texts([text.encode(), b"", text.lower().encode()], 0)] == [ids_of(t) for t in (text, "", text.lower())]
    assert b"W" * 300 not in encoder.numbers and b"HELLO!" in encoder.numbers
    known = len(encoder.begins)
    list(encoder.texts([b"hello... HELLO!", b"world,"], 0))
    assert len(encoder.begins) == known
