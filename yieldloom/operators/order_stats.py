"""Exact weighted order statistics that never bring a whole group into one task.

Rows are first folded into levels (one row per key and distinct value). A coarse, order-preserving
bucket of the value then gives each key a short histogram; running weights over it tell which bucket
holds the wanted position, and only that bucket's levels are looked at again. Group size therefore
shows up in the partial aggregation, where it is spread over all tasks, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per factor e of the value: a bucket is 0.05 % of the value wide, so it holds few whole numbers
# (half a million around one billion), and a key has at most some 180,000 buckets over all of BIGINT.
_RESOLUTION = 2048


def value_bucket(value: Column) -> Column:
    """Order-preserving bucket number: logarithmic in the value's size, mirrored for negatives."""
    size = F.floor(F.log1p(F.abs(value.cast("double"))) * _RESOLUTION).cast("int")
    return F.when(value < 0, -size).otherwise(size)


def value_levels(df: DataFrame, keys: Sequence[str], value: Column, weight: Column | None = None) -> DataFrame:
    """Levels: keys, bucket, value, weight (sum) and rows (count). Null values are left out."""
    weight = F.lit(1).cast("bigint") if weight is None else weight
    return (
        df.select(*keys, value.alias("value"), weight.alias("w"))
        .filter(F.col("value").isNotNull())
        .groupBy(*keys, value_bucket(F.col("value")).alias("bucket"), "value")
        .agg(F.sum("w").alias("weight"), F.count(F.lit(1)).alias("rows"))
    )


def known_levels(df: DataFrame, keys: Sequence[str], value: Column, weight: Column) -> DataFrame:
    """``value_levels`` of rows that already are one per key and value: nothing to fold, no shuffle."""
    return df.filter(value.isNotNull()).select(
        *keys, value_bucket(value).alias("bucket"), value.alias("value"), weight.alias("weight"),
        F.lit(1).cast("bigint").alias("rows"),
    )


def order_points(
    levels: DataFrame,
    keys: Sequence[str],
    targets: Callable[[Column, Column], dict[str, Column]],
    moment: bool = False,
    extremes: bool = False,
) -> DataFrame:
    """For each key and target the smallest value whose running weight reaches the target.

    ``targets(total, rows)`` names the wanted running weights (at least 1; weights are whole numbers).
    Each target becomes a column STRUCT<value, before[, moment]>: the value, the weight strictly below
    it and, with ``moment``, the sum of value * weight strictly below it. ``extremes`` adds the key's
    ``least`` and ``greatest`` value. A key whose total weight does not reach any target has no row.
    """
    if moment:
        product = F.col("value").cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")
        levels = levels.withColumn("moment", product)
    sums = ["weight", "rows"] + (["moment"] if moment else [])
    # Both frames share one ordering, so one sort serves them.
    ordered = Window.partitionBy(*keys).orderBy("bucket")
    running = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    ends = [F.min("value").alias("least"), F.max("value").alias("greatest")] if extremes else []
    histogram = levels.groupBy(*keys, "bucket").agg(*[F.sum(c).alias(c) for c in sums], *ends)
    end_names = ["least", "greatest"] if extremes else []
    marks = histogram.select(
        *keys,
        "bucket",
        F.col("weight").alias("bucket_weight"),
        F.sum("weight").over(whole).alias("total"),
        F.sum("rows").over(whole).alias("total_rows"),
        F.coalesce(F.sum("weight").over(running), F.lit(0)).alias("bucket_before"),
        *([F.coalesce(F.sum("moment").over(running), F.lit(0)).alias("bucket_moment")] if moment else []),
        *([F.min("least").over(whole).alias("least"), F.max("greatest").over(whole).alias("greatest")] if extremes else []),
    )
    wanted = targets(F.col("total").cast("decimal(28,0)"), F.col("total_rows").cast("decimal(28,0)"))
    labels = list(wanted)
    marks = (
        marks.withColumn(
            "mark",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("label"), F.greatest(t, F.lit(1)).cast("decimal(38,0)").alias("at"))
                        for name, t in wanted.items()
                    ]
                )
            ),
        )
        .filter(
            (F.col("bucket_before") < F.col("mark.at"))
            & (F.col("mark.at") <= F.col("bucket_before") + F.col("bucket_weight"))
        )
        .drop("bucket_weight")
    )

    inside = Window.partitionBy(*keys, "label").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    fine = levels.join(marks, [*keys, "bucket"]).select(
        *keys, "total", "total_rows", F.col("mark.label").alias("label"), F.col("mark.at").alias("at"),
        "value", "weight", "bucket_before", *end_names, *(["bucket_moment", "moment"] if moment else []),
    )
    fine = fine.withColumn("before", F.col("bucket_before") + F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    fields = ["value", "before"]
    if moment:
        below = F.col("bucket_moment") + F.coalesce(F.sum("moment").over(inside), F.lit(0))
        fine = fine.withColumn("moment", below)
        fields.append("moment")
    hit = fine.filter((F.col("before") < F.col("at")) & (F.col("at") <= F.col("before") + F.col("weight")))
    # Plain numbers are gathered first and made into structs after: that keeps this a hash aggregate.
    per_key = ["total", "total_rows", *end_names]
    flat = hit.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in per_key],
        *[
            F.max(F.when(F.col("label") == name, F.col(field))).alias(f"{name}_{field}")
            for name in labels
            for field in fields
        ],
    )
    return flat.select(
        *keys,
        *per_key,
        *[F.struct(*[F.col(f"{name}_{field}").alias(field) for field in fields]).alias(name) for name in labels],
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, alias: str = "median") -> DataFrame:
    """Exact median of whole numbers per key, cut toward zero."""
    points = order_points(
        value_levels(df, keys, value),
        keys,
        lambda total, rows: {"low": F.floor((total + 1) / 2), "high": F.floor(total / 2) + 1},
    )
    middle = F.expr("(low.value + high.value) div 2")
    return points.select(*keys, middle.alias(alias))


def weighted_median(df: DataFrame, keys: Sequence[str], value: Column, weight: Column, alias: str) -> DataFrame:
    """Lower weighted median: first value whose running weight reaches half of the total.

    Weights are whole numbers. A key without weight gives 0.
    """
    levels = value_levels(df, keys, value, weight)
    points = order_points(levels, keys, lambda total, rows: {"half": F.ceil(total / 2)})
    every = levels.select(*keys).distinct()
    return every.join(points, list(keys), "left").select(
        *keys, F.coalesce(F.col("half.value"), F.lit(0)).alias(alias)
    )


def share_weight(share: Column) -> Column:
    """A fraction as a whole-number weight, so that sums do not depend on the order of rows."""
    return F.round(share * 1e15, 0).cast("decimal(18,0)")


def half_of_shares(total: Column, rows: Column) -> Column:
    """Half of a total of share weights; each weight is rounded by less than one unit, so ties count as reached."""
    return F.ceil((total - rows) / 2)


def weighted_quantile(
    df: DataFrame, keys: Sequence[str], value: Column, weight: Column, percent: int, alias: str
) -> DataFrame:
    """First value whose running weight reaches ``percent`` of the total."""
    points = order_points(
        value_levels(df, keys, value, weight),
        keys,
        lambda total, rows: {"at": F.ceil(total * percent / 100)},
    )
    return points.select(*keys, F.col("at.value").alias(alias))
