"""Demand lists: an item with very many labels, and every label in a table of its own."""

from pyspark.sql import functions as F

from yieldloom.operators import demand


def test_an_item_with_very_many_labels(spark):
    many = spark.range(1_000_000).select(F.lit("Rope").alias("item"), F.format_string("t%07d", "id").alias("npc"), F.lit("5").alias("npc_price"), F.lit("Low").alias("market_band"))
    few = spark.createDataFrame([("Belt", "RashidTab", "7", "High"), ("Belt", "Everything", "9", ""), ("belt", "Esrik", None, None)], "item string, npc string, npc_price string, market_band string")
    delivery = demand.delivery_rows(many, few)
    imbuing = spark.createDataFrame([("Belt", "Strike", "Basic", 3), (" ", "x", "y", 1)], "item string, imbuement string, tier string, qty int")
    prices = spark.createDataFrame([("Rope", 50, 10)], "item string, fair long, item_id long")
    tags = {r["item"]: r for r in demand.item_tags(imbuing, delivery, prices).collect()}
    assert tags["Rope"]["delivery_npcs"].split("|") == [f"t{i:07d}" for i in range(demand.LISTED)]
    assert (tags["Belt"]["delivery_npcs"], tags["Belt"]["delivery_bands"], tags["Belt"]["imbuements"], tags["Belt"]["npc_price"]) == ("Esrik|Rashid", "High", "Basic Strike x3", 9)
    labels = demand.item_labels(imbuing, delivery)
    assert labels.filter("item_key = 'rope' and kind = 'buyer'").count() == 1_000_000
    assert {(r["kind"], r["label"]) for r in labels.filter("item_key = 'belt'").collect()} == {("buyer", "Esrik"), ("buyer", "Rashid"), ("band", "High"), ("imbuement", "Basic Strike x3")}
