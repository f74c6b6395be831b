"""Targets of a capture, and the cache of lookups with its failures."""

from pyspark.sql import functions as F

from yieldloom.operators import targets
from yieldloom.sources.lookup_cache import LookupCache


def day(text):
    return F.lit(text).cast("date")


def test_targets(spark):
    metadata = spark.createDataFrame([("Gold Coin", 1), ("boots", 2), ("Axe", 3), ("axe", 4), ("bow", 5), ("cape", 6)], "name string, id int")
    watch = spark.createDataFrame([("bow",), ("no such thing",), (None,)], "name string")
    loot = spark.createDataFrame([("gold coins",), ("gold coin",), ("BOOTS",), ("axes",), ("bow",), ("cape",), ("",)], "item string")
    wanted = targets.wanted_items(watch, loot, metadata)
    assert [r["name"] for r in wanted.filter("item_id is null").collect()] == ["no such thing"]
    volumes = spark.createDataFrame([(1, 10), (4, 50), (5, 1), (6, 99)], "item_id int, volume bigint")
    none = spark.createDataFrame([], "item_id int")

    def got(held, *quota):
        return [(r["item_id"], r["position"]) for r in targets.capture_targets(wanted, volumes, held, *quota).orderBy("position").collect()]

    # Watched first, then by name: axes, boots, cape, gold coin; the quota of four leaves out the last.
    assert got(none, 4) == [(5, 1), (4, 2), (2, 3), (6, 4)]
    assert got(none, 4, 3) == [(5, 1), (6, 2), (4, 3)]
    held = spark.createDataFrame([(6,), (5,)], "item_id int")
    assert got(held, 4, 3) == [(4, 3)]
    assert got(none, 99, 99) == [(5, 1), (6, 2), (4, 3), (1, 4), (2, 5)]


def test_lookup_cache(spark, tmp_path):
    cache = LookupCache(spark, str(tmp_path / "cache"), "k")
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "k string")

    def pending(when):
        return sorted(r["k"] for r in cache.pending(wanted, day(when)).collect())

    assert cache.answers() is None and pending("2026-01-01") == ["a", "b", "c"]
    answers = spark.createDataFrame([("a", 1)], "k string, v int")
    tried = spark.createDataFrame([("a",), ("b",)], "k string")
    for _ in range(2):  # a repeated run changes nothing
        cache.record(1, tried, answers, day("2026-01-01"))
        assert pending("2026-01-02") == ["c"]
    assert pending("2026-01-08") == ["b", "c"]
    # The failed key is found later; a held key that fails keeps its answer.
    cache.record(2, spark.createDataFrame([("b",), ("a",)], "k string"), spark.createDataFrame([("b", 2)], "k string, v int"), day("2026-01-08"))
    assert pending("2026-01-08") == ["c"]
    assert {(r["k"], r["v"]) for r in cache.answers().collect()} == {("a", 1), ("b", 2)}
    assert {(r["k"], str(r["failed_on"])) for r in cache.failures().collect()} == {("b", "2026-01-01"), ("a", "2026-01-08")}
