"""Order statistics against plain Python on random groups."""

import random
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yieldloom.operators import order_stats, prices


def plain_weighted_median(pairs):
    total, acc = sum(w for _, w in pairs), 0
    if total <= 0:
        return 0
    for v, w in sorted(pairs):
        acc += w
        if 2 * acc >= total:
            return v


def plain_trimmed(pairs, percent):
    total = sum(u for _, u in pairs)
    if total == 0:
        return None
    cut, rest = total * percent, []  # in hundredths of units
    for p, u in sorted(pairs, reverse=True):
        u *= 100
        if cut >= u:
            cut -= u
            continue
        rest.append((p, u - cut))
        cut = 0
    rest = rest or pairs
    return sum(p * u for p, u in rest) // sum(u for _, u in rest)


def random_rows(seed, spread):
    rng = random.Random(seed)
    return [
        (g, rng.choice([rng.randint(-spread, spread), rng.randint(1, 9)]), rng.randint(0, 5))
        for g in range(60)
        for _ in range(rng.randint(1, 40))
    ]


def test_weighted_median_and_median(spark):
    for spread in (3, 5000, 10**12):
        rows = random_rows(spread, spread)
        df = spark.createDataFrame(rows, "g int, v bigint, w bigint")
        got = {r["g"]: r["m"] for r in order_stats.weighted_median(df, ["g"], F.col("v"), F.col("w"), "m").collect()}
        med = {r["g"]: r["median"] for r in order_stats.exact_median(df, ["g"], F.col("v")).collect()}
        groups = {}
        for g, v, w in rows:
            groups.setdefault(g, []).append((v, w))
        for g, pairs in groups.items():
            assert got[g] == plain_weighted_median(pairs)
            vals = sorted(v for v, _ in pairs)
            two = vals[(len(vals) - 1) // 2] + vals[len(vals) // 2]
            assert med[g] == (abs(two) // 2) * (1 if two >= 0 else -1)


def test_scaling_weights_changes_nothing(spark):
    df = spark.createDataFrame(random_rows(7, 100), "g int, v bigint, w bigint")
    one = order_stats.weighted_median(df, ["g"], F.col("v"), F.col("w"), "m").collect()
    ten = order_stats.weighted_median(df, ["g"], F.col("v"), F.col("w") * 10, "m").collect()
    assert sorted(one) == sorted(ten)


def test_share_weights_count_exact_ties_as_reached(spark):
    rows = [("a", 1.0, 2 / 7), ("a", 2.0, 2 / 7), ("a", 3.0, 4 / 7), ("b", 3.0, 4 / 7), ("b", 4.0, 2 / 7), ("b", 5.0, 2 / 7)]
    df = spark.createDataFrame(rows, "g string, v double, s double")
    levels = order_stats.value_levels(df, ["g"], F.col("v"), order_stats.share_weight(F.col("s")))
    points = order_stats.order_points(levels, ["g"], lambda t, n: {"half": order_stats.half_of_shares(t, n)})
    assert {r["g"]: r["half"]["value"] for r in points.collect()} == {"a": 2.0, "b": 3.0}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    books=st.lists(
        st.lists(st.tuples(st.integers(1, 400), st.integers(0, 30)), min_size=1, max_size=25), min_size=1, max_size=12
    ),
    percent=st.sampled_from([0, 5, 25, 99, 100]),
)
def test_trimmed_vwap(spark, books, percent):
    rows = [(i, "buy", p, u) for i, book in enumerate(books) for p, u in book]
    ladder = spark.createDataFrame(rows, "item_id int, side string, price bigint, units bigint")
    got = {r["item_id"]: r["fair"] for r in prices.trimmed_vwap(ladder, percent).collect()}
    for i, book in enumerate(books):
        assert got.get(i) == plain_trimmed(book, percent), (book, percent)


def test_bucket_keeps_order(spark):
    values = sorted([0, 1, 2, 255, 256, 10**6, 10**6 + 1, 10**18, -1, -5, -(10**9)] + [3**k for k in range(35)])
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r["b"] for r in df.orderBy("v").select(order_stats.value_bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got)


def test_median_of_one_hot_group(spark):
    df = spark.range(20001).select(F.lit("hot").alias("g"), (F.col("id") * 7).alias("v"))
    assert order_stats.exact_median(df, ["g"], F.col("v")).first()["median"] == 70000
    assert statistics.median(range(0, 20001 * 7, 7)) == 70000
