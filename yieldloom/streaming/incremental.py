"""Incremental state: newest row per key, and append-only stores without repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import keyed_store
from ..sources.documents import path_exists

#: Buckets of a store's keys.
KEY_BUCKETS = 64


def upsert_latest(
    source: DataFrame, path: str, checkpoint: str, keys: Sequence[str], version: Sequence[str], every: int = keyed_store.EVERY,
    buckets: int = keyed_store.BUCKETS,
) -> None:
    """Fold everything that has arrived into the store at ``path`` and stop.

    Each batch is a run of the store: it rewrites only the buckets of keys it touches, and a batch that is run again after
    a failure overwrites its own part, so nothing counts twice. Rows without a key are one key. ``buckets`` is fixed when a
    store begins: about the bytes of the state over 200 MB.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        keyed_store.fold(batch, path, batch_id, keys, version, every=every, buckets=buckets)

    _run(source.writeStream.foreachBatch(fold), checkpoint)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Current state: newest row per key, later batches winning ties."""
    return keyed_store.read(spark, path, keys, version)


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deduplicated(source: DataFrame, key: str, event_time: str, within: str) -> DataFrame:
    """A stream whose repeats of a key, arriving within so much event time, are dropped; rows without a key all stay.

    The keys seen are the query's own state, in its state store and checkpoint: a restarted query knows them. A key is
    forgotten once the watermark has passed it by ``within``, so state is bounded by the keys of that span, not by the
    whole history; a row that comes later than that is late and dropped, with or without a key.
    """
    timed = source.withWatermark(event_time, within)
    keyed = timed.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return keyed.unionByName(timed.filter(F.col(key).isNull()))


def append_deduplicated(source: DataFrame, path: str, checkpoint: str, key: str, event_time: str, within: str) -> None:
    """Append a stream without repeats of keys to the Parquet files at ``path``, each batch exactly once, and stop."""
    stream = deduplicated(source, key, event_time, within)
    _run(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def append_unseen(source: DataFrame, path: str, checkpoint: str, key: str, version: Sequence[str]) -> None:
    """Append rows whose key no earlier batch brought; of repeats within a batch the earliest stays.

    The store itself remembers the keys, so no streaming state grows without end. It is laid out by a hash of the key,
    and a batch reads the keys of the buckets it touches only.
    """
    from ..operators.latest import append_new

    spark = source.sparkSession
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(KEY_BUCKETS)).cast("int")

    def fold(batch: DataFrame, batch_id: int) -> None:
        store = batch.limit(0)
        if path_exists(spark, f"{path}/batch=*"):
            touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # KEY_BUCKETS at most
            held = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
            store = held.filter((F.col("batch") != batch_id) & F.col("key_bucket").isin(touched)).drop("batch", "key_bucket")
        fresh = append_new(store, batch, key, version).withColumn("key_bucket", bucket)
        fresh.write.mode("overwrite").partitionBy("key_bucket").parquet(f"{path}/batch={batch_id}")

    _run(source.writeStream.foreachBatch(fold), checkpoint)
