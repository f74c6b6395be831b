"""Result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_gold(
    df: DataFrame, path: str, columns: Sequence[str], partition: str | None = None,
    order: Sequence[Column] = (), fmt: str = "parquet",
) -> None:
    """Write exactly the listed columns, sorted in a distributed way, optionally one folder per ``partition``."""
    out = df.select(*columns)
    if order:
        out = out.orderBy(*order) if partition is None else out.orderBy(F.col(partition), *order)
    writer = out.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_ladder(ladder: DataFrame, path: str, buckets: int = 64) -> None:
    """Long ladder table, one folder per hash bucket of the item: reading one item prunes to one folder.

    A folder per item would mean millions of tiny files; rows of a bucket are clustered by item instead.
    """
    bucket = item_bucket(F.col("item_id"), buckets)
    (
        ladder.withColumn("item_bucket", bucket)
        .repartitionByRange("item_bucket", "item_id", "side", "price")
        .sortWithinPartitions("item_bucket", "item_id", "side", "price")
        .write.mode("overwrite").partitionBy("item_bucket").parquet(path)
    )


def read_item(spark: SparkSession, path: str, item_id: int, buckets: int = 64) -> DataFrame:
    """Rows of one item from a table written by ``write_ladder``."""
    wanted = item_bucket(F.lit(item_id).cast("bigint"), buckets)
    return spark.read.parquet(path).filter((F.col("item_bucket") == wanted) & (F.col("item_id") == item_id))


def item_bucket(item_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(item_id), F.lit(buckets)).cast("int")
