"""Newest row per key, kept across runs in buckets: a run rewrites only the buckets its rows fall into.

``<path>/part=<n>/kind=<base|delta>/key_bucket=<b>`` holds what run n wrote for bucket b. ``<path>/manifest/<n>`` lists, for every
bucket, the base and the deltas that make up its state after run n, and what callers note with it. A reader takes the
newest manifest and opens only what it lists. A manifest appears by a rename, so a run is in the state wholly or not at
all; a run that is repeated overwrites its own part and its own manifest with the same rows. Parts that no manifest lists
any more stay for readers at work; whoever owns the store removes them.

A run writes a delta for each bucket it touches. A bucket that has gathered ``every`` deltas is merged into a new base
instead; other buckets are left alone. Manifests hold a few numbers a bucket, whatever the table's size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.latest import latest_by_key

BUCKETS, EVERY = 64, 16
PART = "part"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; null keys have one too."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs that have a manifest, ascending."""
    fs, pattern = _fs(spark, f"{path}/manifest/[0-9]*")
    return sorted(int(f.getPath().getName()) for f in fs.globStatus(pattern) or [])


def manifest(spark: SparkSession, path: str, before: int | None = None) -> dict:
    """The newest manifest, or the newest of a run before the given one."""
    known = [n for n in runs(spark, path) if before is None or n < before]
    if not known:
        return {"buckets": {}, "notes": {}}
    text = spark.read.option("wholetext", True).text(f"{path}/manifest/{known[-1]}").first()
    return json.loads(text["value"])


def _publish(spark: SparkSession, path: str, number: int, content: dict) -> None:
    fs, draft = _fs(spark, f"{path}/_draft-{number}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    _, final = _fs(spark, f"{path}/manifest/{number}")
    fs.mkdirs(final.getParent())
    if fs.exists(final):
        fs.delete(final, False)
    fs.rename(draft, final)


def _rows(spark: SparkSession, path: str, schema: StructType, entries: dict[str, dict]) -> DataFrame:
    """Rows of the listed bases and deltas, with the number of the run that wrote them."""
    paths = []
    for bucket, entry in entries.items():
        paths += [f"{path}/{PART}={entry['base']}/kind=base/key_bucket={bucket}"] if entry["base"] is not None else []
        paths += [f"{path}/{PART}={n}/kind=delta/key_bucket={bucket}" for n in entry["deltas"]]
    if not paths:
        return spark.createDataFrame([], schema).withColumn(PART, F.lit(None).cast("bigint"))
    read = spark.read.schema(schema).option("basePath", path).parquet(*paths)
    return read.select(*schema.fieldNames(), F.col(PART).cast("bigint").alias(PART))


def fold(
    rows: DataFrame, path: str, number: int, keys: Sequence[str], version: Sequence[str], notes: dict | None = None,
    every: int = EVERY, buckets: int = BUCKETS,
) -> None:
    """Fold rows into the store as run ``number``; of a key the row of greatest version stays, of equal ones the later run's."""
    spark = rows.sparkSession
    held = manifest(spark, path, number)
    entries: dict[str, dict] = held["buckets"]
    fresh = latest_by_key(rows, keys, version).withColumn("key_bucket", bucket_of(keys, buckets))
    touched = sorted(str(r[0]) for r in rows.select(bucket_of(keys, buckets)).distinct().collect())  # the number of buckets at most
    ripe = {b: entries[b] for b in touched if b in entries and len(entries[b]["deltas"]) + 1 >= every}
    out = fresh.withColumn("kind", F.when(F.col("key_bucket").isin([int(b) for b in ripe]), "base").otherwise("delta"))
    if ripe:
        old = _rows(spark, path, rows.schema, ripe).withColumn("key_bucket", bucket_of(keys, buckets))
        new = out.filter("kind = 'base'").drop("kind").withColumn(PART, F.lit(number).cast("bigint"))
        merged = latest_by_key(old.unionByName(new), [*keys, "key_bucket"], [*version, PART]).drop(PART)
        out = out.filter("kind = 'delta'").unionByName(merged.withColumn("kind", F.lit("base")))
    # Buckets are dealt out whole, large ones in several parts: few files, none of them huge.
    out.hint("rebalance", "kind", "key_bucket").write.mode("overwrite").partitionBy("kind", "key_bucket").parquet(f"{path}/{PART}={number}")
    for bucket in touched:
        entry = entries.get(bucket, {"base": None, "deltas": []})
        entries[bucket] = {"base": number, "deltas": []} if bucket in ripe else {"base": entry["base"], "deltas": entry["deltas"] + [number]}
    _publish(spark, path, number, {"schema": rows.schema.json(), "buckets": entries, "notes": {**held["notes"], **(notes or {})}})


def read(
    spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str], only: Column | None = None, before: int | None = None
) -> DataFrame:
    """The store's state: newest row per key. ``only`` is applied to keys before rows are compared.

    With ``before`` the state is the one that the runs before that number left.
    """
    now = manifest(spark, path, before)
    rows = _rows(spark, path, StructType.fromJson(json.loads(now["schema"])), now["buckets"])
    rows = rows if only is None else rows.filter(only)
    return latest_by_key(rows, keys, [*version, PART]).drop(PART)
