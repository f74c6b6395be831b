"""Streams give the same state as their batch twins, also over several runs and after a repeated batch."""

import glob
import os

from pyspark.sql import functions as F

from yieldloom.operators.latest import append_new, cooled_down, latest_by_key, pending_keys, replace_rows
from yieldloom.sources import keyed_store, snapshots
from yieldloom.streaming import incremental

SCHEMA = "id string, v int, day string"
DAYS = [
    [("a", 1, "d1"), ("b", 1, "d1"), ("a", 2, "d1")],
    [("a", 0, "d2"), ("c", 5, "d2")],
    [("b", 7, "d0"), ("c", 6, "d3")],
]


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_upsert_in_runs(spark, tmp_path):
    source, state, log = (f"{tmp_path}/{n}" for n in ("in", "state", "log"))
    everything = []
    for rows in DAYS:
        feed(spark, source, rows)
        everything += rows
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        incremental.upsert_latest(stream, state, log, ["id"], ["day", "v"])
        twin = latest_by_key(spark.createDataFrame(everything, SCHEMA), ["id"], ["day", "v"])
        assert sorted(incremental.read_latest(spark, state, ["id"], ["day", "v"]).collect()) == sorted(twin.collect())
    # A batch run again leaves the state as it was.
    keyed_store.fold(spark.createDataFrame(DAYS[2], SCHEMA), state, 2, ["id"], ["day", "v"])
    assert sorted(incremental.read_latest(spark, state, ["id"], ["day", "v"]).collect()) == sorted(twin.collect())


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    source, state, log = (f"{tmp_path}/{n}" for n in ("in", "state", "log"))
    everything = []
    for rows in DAYS + DAYS[::-1] + [[(None, 3, "d4"), (None, 4, "d1")], [("a", 9, "d9")], [("a", 1, "d9")]]:
        feed(spark, source, rows)
        everything += rows
        before = {f for f in glob.glob(f"{state}/part=*/**/*.parquet", recursive=True)}
        incremental.upsert_latest(spark.readStream.schema(SCHEMA).parquet(source), state, log, ["id"], ["day", "v"], every=2)
        written = {f for f in glob.glob(f"{state}/part=*/**/*.parquet", recursive=True)} - before
        assert {f.split("key_bucket=")[1].split("/")[0] for f in written} == {
            str(r[0]) for r in spark.createDataFrame(rows, SCHEMA).select(keyed_store.bucket_of(["id"], 64)).distinct().collect()
        }
    twin = latest_by_key(spark.createDataFrame(everything, SCHEMA), ["id"], ["day", "v"])
    now = incremental.read_latest(spark, state, ["id"], ["day", "v"])
    order = lambda rows: sorted(map(str, rows))
    assert order(now.collect()) == order(twin.collect()) and now.filter("id is null").count() == 1
    held = keyed_store.manifest(spark, state)["buckets"]
    assert all(len(e["deltas"]) < 2 for e in held.values()) and any(e["base"] is not None for e in held.values())


def test_a_run_without_manifest_does_not_count(spark, tmp_path):
    state = f"{tmp_path}/state"
    keyed_store.fold(spark.createDataFrame(DAYS[0], SCHEMA), state, 0, ["id"], ["day", "v"])
    spark.createDataFrame(DAYS[1], SCHEMA).withColumn("kind", F.lit("delta")).withColumn("key_bucket", F.lit(1)).write.partitionBy("kind", "key_bucket").parquet(f"{state}/part=1")
    assert sorted(map(tuple, keyed_store.read(spark, state, ["id"], ["day", "v"]).collect())) == [("a", 2, "d1"), ("b", 1, "d1")]


def test_deduplicated_stream_restarts_and_expires(spark, tmp_path):
    source, out, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    schema = "id string, ts timestamp, v int"

    def deliver(*rows):
        stamped = spark.createDataFrame([(k, f"2026-01-01 00:{m:02d}:00", v) for k, m, v in rows], "id string, ts string, v int")
        stamped.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(source)
        incremental.append_deduplicated(spark.readStream.schema(schema).parquet(source), out, log, "id", "ts", "10 minutes")

    deliver(("a", 1, 1), ("b", 2, 1), (None, 2, 1), (None, 2, 2))
    deliver(("a", 5, 2), ("c", 5, 1), (None, 5, 3))  # a restarted query still knows "a"
    deliver(("d", 40, 1))
    deliver(("a", 41, 3), ("b", 41, 2), ("c", 3, 9))  # forgotten by now; the last is late
    got = sorted((r["id"] or "", r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [("", 1), ("", 2), ("", 3), ("a", 1), ("a", 3), ("b", 1), ("b", 2), ("c", 1), ("d", 1)]


def test_folding_captures_opens_new_days_only(spark, tmp_path):
    root, store = f"{tmp_path}/raw", f"{tmp_path}/store"

    def now():
        return sorted((r["id"], r["v"], str(r["capture_date"])) for r in keyed_store.read(spark, store, ["id"], ["capture_date"]).collect())

    def land_flat(day, rows):
        os.makedirs(f"{root}/{day}", exist_ok=True)
        with open(f"{root}/{day}/y.csv", "w") as f:
            f.write("id,v\n" + "".join(f"{a},{b}\n" for a, b in rows))

    fold = lambda: snapshots.fold_captures(spark, root, "y.csv", "id string, v string", store, ["id"])
    land_flat("2026-01-02", [("a", 2), ("b", 2)])
    land_flat("2026-01-03", [("a", 3)])
    assert fold() == ["2026-01-02", "2026-01-03"] and fold() == []
    land_flat("2026-01-04", [("c", 4)])
    land_flat("2026-01-01", [("a", 1), ("d", 1)])
    land_flat("2026-01-03", [("a", "changed, and not read again")])
    assert fold() == ["2026-01-01", "2026-01-04"]
    assert now() == [("a", "3", "2026-01-03"), ("b", "2", "2026-01-02"), ("c", "4", "2026-01-04"), ("d", "1", "2026-01-01")]


def test_append_in_runs(spark, tmp_path):
    source, store, log = (f"{tmp_path}/{n}" for n in ("in", "store", "log"))
    for rows in DAYS:
        feed(spark, source, rows)
        incremental.append_unseen(spark.readStream.schema(SCHEMA).parquet(source), store, log, "id", ["day", "v"])
    got = sorted((r["id"], r["v"], r["day"]) for r in spark.read.parquet(store).collect())
    assert got == [("a", 1, "d1"), ("b", 1, "d1"), ("c", 5, "d2")]


def test_append_batch_twin(spark):
    store = spark.createDataFrame(DAYS[0], SCHEMA)
    fresh = append_new(store, spark.createDataFrame(DAYS[1] + DAYS[2], SCHEMA), "id", ["day", "v"])
    assert [tuple(r) for r in fresh.collect()] == [("c", 5, "d2")]


def test_replace_rows_and_children(spark):
    old = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "id string, child string")
    new = spark.createDataFrame([("a", "q"), ("c", "r")], "id string, child string")
    assert sorted(map(tuple, replace_rows(old, new, "id").collect())) == [("a", "q"), ("b", "z"), ("c", "r")]


def test_pending_and_cooldown(spark):
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",)], "k string")
    pending = pending_keys(wanted, wanted.filter("k = 'b'"), "k")
    failures = spark.createDataFrame(
        [("a", "2026-01-01"), ("a", "2026-01-09"), ("c", "2026-01-03"), ("z", "2026-01-10")], "k string, failed_on string"
    ).withColumn("failed_on", F.to_date("failed_on"))
    left = cooled_down(pending, failures, "k", F.lit("2026-01-10").cast("date"))
    assert sorted(r["k"] for r in left.collect()) == ["c", "d"]
