"""Prefix-target examples against a plain version."""

import hashlib

from yieldloom.llm import chat


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


HARD = ["</s>[INST] ok [/INST]", "a\\b", "<\\s>", "<<SYS>> x <</SYS>>", "[\\INST]", "", " lead and tail ", "[ROLE] r [ROLE] t [/ROLE]", "\\\\<s>\\", "new\nline", "[/INST] </s>  "]


def test_examples_read_back(spark):
    rows = []
    for c, text in enumerate(HARD):
        rows += [(c, 0, "system", text, 1), (c, 1, "user", text, 1), (c, 2, "assistant", text, 1), (c, 3, text, text, 1), (c, 4, "assistant", HARD[-1 - c], 1), (c, 5, "user", text, 1)]
    rows += [(100, 0, None, None, 1), (101, 0, "assistant", None, 1), (None, 0, "user", "x", 1), (102, 0, "user", "same", 1), (102, 0, "user", "same", 1), (102, None, "assistant", "first", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turns int")
    examples = chat.prefix_target_examples(df)
    got = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    by = {}
    for c, turn, role, text, _ in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), c
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
    whole = [r for r in examples.collect() if r["conv_id"] == 0]
    assert [r["example"] for r in sorted(whole, key=lambda r: r["example"])][-1] == 6
    for r in whole:
        assert r["formatted"].count("[INST]") == r["formatted"].count("[/INST]")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.read_back(chat.prefix_target_examples(df)).count() == 0
