"""First k rows of a table or of each group, and positions in sorted views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each group. The planner cuts to k per group before the shuffle as well."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).filter(F.col(rank) <= k)


def first_values(df: DataFrame, keys: Sequence[str], value: str, k: int, separator: str, alias: str) -> DataFrame:
    """Per group the k smallest distinct values as one joined text."""
    top = top_per_group(df.select(*keys, value).distinct(), keys, [F.col(value)], k)
    return joined(top, keys, value, separator, alias)


def joined(ranked: DataFrame, keys: Sequence[str], value: str, separator: str, alias: str) -> DataFrame:
    """Join the values of already ranked (hence bounded) groups in rank order."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", value)))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda p: p[value]), separator).alias(alias))


def top_n(df: DataFrame, order: Sequence[Column], n: int, position: str | None = None) -> DataFrame:
    """First n rows of the whole table; positions are numbered only after the cut."""
    top = df.orderBy(*order).limit(n)
    if position is None:
        return top
    return top.withColumn(position, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def percent_of_max(top: DataFrame, value: str, alias: str = "pct") -> DataFrame:
    """Share of the largest value in percent, at least 1. Expects an already cut top list."""
    largest = F.greatest(F.lit(1), F.max(value).over(Window.partitionBy()))
    return top.withColumn(alias, F.greatest(F.lit(1), F.round(F.col(value) / largest * 100, 0)).cast("bigint"))
