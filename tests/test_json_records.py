"""Records of large JSON documents against the json module, with splits of a few bytes."""

import json
import random

import pytest

from yieldloom.sources import json_records


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    held = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in zip(names, held):
        spark.conf.set(n, v)


def write(tmp_path, day, text):
    folder = tmp_path / "raw" / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "doc.json").write_text(text)


TEXTS = ["plain", 'quote " and, comma', "back\\slash,", "[{,}]", "}", "é,ü", "", "tab\t", '\\",', "{\"a\":[1,2"]


def book(rng):
    return {"sellers": [{"name": rng.choice(TEXTS), "price": rng.randrange(99)} for _ in range(rng.randrange(4))], "time": rng.random()}


VALUE = "struct<sellers:array<struct<name:string,price:bigint>>,time:double>"


@pytest.mark.parametrize("indent", [None, 1])
def test_map_documents(spark, tmp_path, small_splits, indent):
    rng = random.Random(indent)
    documents = {f"2026-01-0{d}": {f"{rng.choice(TEXTS)} {i}": book(rng) for i in range(rng.randrange(1, 60))} for d in range(1, 5)}
    for day, document in documents.items():
        write(tmp_path, day, json.dumps(document, indent=indent, ensure_ascii=rng.random() < 0.5))
    write(tmp_path, "2026-01-08", "{}")
    write(tmp_path, "2026-01-09", '{"cut": {"sellers": [')
    rows = json_records.read_map_captures(spark, str(tmp_path / "raw"), "doc.json", VALUE)
    assert rows.rdd.getNumPartitions() >= 1 and json_records.fragments(spark, str(tmp_path / "raw" / "*" / "doc.json")).select("path", "block").distinct().count() > 20
    got = {(str(r["capture_date"]), r["key"]): (None if r["sellers"] is None else [tuple(s) for s in r["sellers"]], r["time"]) for r in rows.collect()}
    wanted = {(day, k): ([(s["name"], s["price"]) for s in v["sellers"]], v["time"]) for day, doc in documents.items() for k, v in doc.items()}
    assert got == wanted
    last = json_records.read_map_captures(spark, str(tmp_path / "raw"), "doc.json", VALUE, n=3)
    assert last.count() == len(documents["2026-01-04"])


def test_plain_values_and_one_large_record(spark, tmp_path, small_splits):
    document = {"a": list(range(500)), "b": [], "c": [7]}
    write(tmp_path, "2026-01-01", json.dumps(document))
    rows = json_records.read_map_captures(spark, str(tmp_path / "raw"), "doc.json", "array<bigint>")
    assert {r["key"]: r["record"] for r in rows.collect()} == document


def test_arrays_and_single_objects(spark, tmp_path, small_splits):
    rng = random.Random(4)
    rows = [{"id": i, "name": rng.choice(TEXTS), "tags": [rng.choice(TEXTS) for _ in range(i % 4)]} for i in range(80)]
    write(tmp_path, "2026-01-01", json.dumps(rows, indent=2))
    write(tmp_path, "2026-01-02", json.dumps(rows[3]))
    write(tmp_path, "2026-01-03", " [] ")
    write(tmp_path, "2026-01-04", '[{"id": 1}')
    got = json_records.read_array_captures(spark, str(tmp_path / "raw"), "doc.json", "id bigint, name string, tags array<string>").collect()
    wanted = [("2026-01-01", r["id"], r["name"], r["tags"]) for r in rows] + [("2026-01-02", 3, rows[3]["name"], rows[3]["tags"])]
    assert sorted((str(r["capture_date"]), r["id"], r["name"], r["tags"]) for r in got) == sorted(wanted)
