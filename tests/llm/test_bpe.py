"""Byte-level BPE against the tokenizer library, and the way back."""

import base64

import public_tokenizers
import pytest
import tiktoken

from yieldloom.llm import bpe
from yieldloom.llm.queries import BPE_FILE

PATH = public_tokenizers.path(BPE_FILE)
TEXTS = [
    "", None, "hello world", "  two  spaces\n\n\ttabs ", "Übergröße für 12345 Straßen's don't", "名前は🙂🙃 zero​width",
    "a" * 3000, "ab" * 2000 + " x", "\x00\x07 control <|endoftext|> </s>", "é" * 700, " " * 900, "word " * 5000,
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_library_and_comes_back(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (0, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode(df, PATH, public_tokenizers.PATTERN, decoded=True).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for i, text in enumerate(TEXTS):
        assert list(by_id[i]["ids"]) == library.encode_ordinary(text or "")
        assert bytes(by_id[i]["decoded"]) == (text or "").encode()


def test_long_pieces_and_queries_agree(library):
    tokenizer = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    for text in ("ab" * 200, "Donaudampfschifffahrtsgesellschaft" * 10, "=" * 300):
        assert tokenizer.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_decode_alone(spark):
    df = spark.createDataFrame([(1, [10, 11]), (2, []), (3, None), (4, [10**6])], "doc_id long, ids array<int>")
    out = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(df, PATH, public_tokenizers.PATTERN).collect()}
    ranks = {v: k for k, v in bpe.load_ranks(PATH).items()}
    assert out == {1: ranks[10] + ranks[11], 2: b"", 3: b"", 4: b""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(df, PATH, public_tokenizers.PATTERN).count() == 0


def test_many_long_unbroken_pieces(tmp_path, monkeypatch):
    import os
    import random
    import time

    monkeypatch.chdir(tmp_path)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(300)) for _ in range(400)]
    tokenizer = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    begun = time.time()
    got = [list(x) for x in tokenizer.encode(texts)]
    assert time.time() - begun < 30 and not os.listdir(tmp_path)
    assert got == [list(tokenizer._encode_long(t.encode())) for t in texts]


def test_new_pieces_cost_few_calls():
    import random
    import sys

    rng = random.Random(4)
    tokenizer = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    text = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 12))) for _ in range(3000))
    pieces, calls = tokenizer.pattern.findall(text), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids = tokenizer.encode([text])[0]
    finally:
        sys.setprofile(None)
    assert ids.tolist() == [i for p in pieces for i in tokenizer._encode_long(p.encode())]
    assert len(set(pieces)) > 2000 and calls < 8 * len(set(pieces))  # 15 when each piece had an array of its own
