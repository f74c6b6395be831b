"""The pipeline's stages on planted documents."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from yieldloom.llm.queries import BPE_FILE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    own = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = own(30)
    texts = {i: own(rng.randrange(20, 60)) for i in range(400)}
    toxic = set(range(0, 400, 5))
    for i in toxic:
        texts[i] = texts[i] + rng.choice([" idiot ", " you moron "]) + own(5)
    texts[401] = own(20) + " 1d10t " + own(20)
    texts[402] = own(20) + " m o r o n " + own(20)
    texts[410] = texts[1] + " end"
    texts[411] = texts[1]
    texts[420] = own(10) + " " + item + " " + own(10)
    texts[430] = own(10) + ' token = "0123456789abcdef0123456789abcdef" ' + own(10)
    texts[440], texts[441] = None, ""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()] + [(2, texts[2], "en", "s", len(texts[2])), (None, own(30), None, None, None)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, toxic


def test_stages(spark, folder):
    path, texts, toxic = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "token ids":
            assert out.schema.names == docs.schema.names
            docs = spark.createDataFrame(out.collect(), SCHEMA)
            kept.append({r["doc_id"] for r in docs.collect()})
    clean = {i for i in texts if i not in toxic and i not in (401, 402)} | {None}
    assert kept[0] == clean
    assert kept[1] == clean - {410, 411}
    assert kept[2] == kept[3] == clean - {410, 411, 420}
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert docs.count() == len(rows), "one row of those that repeat"
    assert "[SECRET]" in rows[430]["text"] and not re.search("[0-9a-f]{20}", rows[430]["text"]) and rows[430]["n_chars"] == len(rows[430]["text"])
    assert rows[440]["text"] is None and rows[441]["text"] == ""
    assert all(rows[i]["text"] == texts[i] for i in rows if i not in (None, 430))

    with open(public_tokenizers.path(BPE_FILE), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(final) == set(rows)
    for i, r in rows.items():
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        assert final[i]["n_tokens"] == len(ids)
        assert final[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert final[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_id_with_several_texts(spark):
    b, z = (" ".join(f"{w}{i}" for i in range(40)) for w in "bz")
    rows = [(3, b, "x", 1, 1), (5, b + " more", "x", 2, 2), (5, z, "x", 3, 3), (5, z, "x", 4, 4), (7, None, "x", 5, 5), (7, None, "x", 6, 6), (None, b, "x", 7, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row int, place int")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["row"]) for r in left) == sorted([(3, b, 1), (5, z, 3), (7, "", 5), (0, b, 7)])
    assert docs.columns == list(left[0].asDict())
