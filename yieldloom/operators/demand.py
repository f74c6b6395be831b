"""Demand tags of items: imbuing materials and delivery lists, with prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prices import price_by_name
from .topk import first_values, top_n

# A tab name that stands for a buyer, a tab that is no buyer, and the two demand marks.
BUYER_RENAMES = {"RashidTab": "Rashid"}
NO_BUYER = "Everything"
IMBUING_MARK, DELIVERY_MARK = "🧪", "📦"


#: Labels of one kind that an item's text lists; ``item_labels`` holds all of them.
LISTED = 1000


def _label_list(labels: DataFrame, alias: str) -> DataFrame:
    """First sorted distinct labels of an item as one text, cut to ``LISTED`` before the shuffle: a list stays short however
    many labels an item has."""
    return first_values(labels.filter(F.col("label") != ""), ["item_key"], "label", LISTED, "|", alias)


def imbuing_labels(imbuing: DataFrame) -> DataFrame:
    """(item_key, label) with label ``tier imbuement xqty``."""
    text = F.concat_ws(
        " ", F.coalesce("tier", F.lit("")), F.coalesce("imbuement", F.lit("")),
        F.concat(F.lit("x"), F.coalesce(F.col("qty").cast("string"), F.lit(""))),
    )
    return (
        imbuing.filter(F.coalesce(F.col("item"), F.lit("")) != "")
        .select(F.lower(F.trim("item")).alias("item_key"), F.trim(text).alias("label"))
        .distinct()
    )


def delivery_rows(*lists: DataFrame) -> DataFrame:
    """Delivery lists under one schema: item, npc, npc_price, market_band; blank items skipped."""
    out = None
    for df in lists:
        for column in ("npc", "npc_price", "market_band"):
            if column not in df.columns:
                df = df.withColumn(column, F.lit(None).cast("string"))
        df = df.select(
            F.trim("item").alias("item"), F.trim("npc").alias("npc"),
            F.replace(F.col("npc_price").cast("string"), F.lit(" "), F.lit("")).try_cast("bigint").alias("npc_price"),
            F.trim("market_band").alias("market_band"),
        ).filter(F.col("item") != "")
        out = df if out is None else out.unionByName(df)
    return out


def _buyer_labels(delivery: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(item_key, label)`` of buyers and of price bands."""
    rows = delivery.withColumn("item_key", F.lower("item"))
    npc = F.col("npc")
    for old, new in BUYER_RENAMES.items():
        npc = F.when(F.col("npc") == old, F.lit(new)).otherwise(npc)
    buyers = rows.filter(F.col("npc") != NO_BUYER).select("item_key", npc.alias("label")).distinct()
    return buyers, rows.select("item_key", F.col("market_band").alias("label")).distinct()


def item_labels(imbuing: DataFrame, delivery: DataFrame) -> DataFrame:
    """Every label of every item, a row each: ``(item_key, kind, label)``. Texts of ``item_tags`` list the first ones only."""
    buyers, bands = _buyer_labels(delivery)
    kinds = {"imbuement": imbuing_labels(imbuing), "buyer": buyers, "band": bands}
    tables = [rows.select("item_key", F.lit(kind).alias("kind"), "label") for kind, rows in kinds.items()]
    return tables[0].unionByName(tables[1]).unionByName(tables[2]).filter(F.col("label") != "")


def item_tags(imbuing: DataFrame, delivery: DataFrame, prices: DataFrame) -> DataFrame:
    """One row per item any list names, with its labels, best buyer price and fair price."""
    materials = _label_list(imbuing_labels(imbuing), "imbuements")
    rows = delivery.withColumn("item_key", F.lower("item"))
    buyers, bands = _buyer_labels(delivery)
    buyers, bands = _label_list(buyers, "delivery_npcs"), _label_list(bands, "delivery_bands")
    facts = rows.groupBy("item_key").agg(
        F.min("item").alias("delivery_name"),
        F.max(F.when(F.col("npc_price") != 0, F.col("npc_price"))).alias("npc_price"),
    )
    priced = price_by_name(prices).select(F.col("price_key").alias("item_key"), F.col("item").alias("price_name"), "fair")
    blank = F.lit("")
    return (
        facts.join(buyers, "item_key", "left").join(bands, "item_key", "left")
        .join(materials, "item_key", "full_outer")
        .join(priced, "item_key", "left")
        .select(
            F.coalesce("price_name", "delivery_name", "item_key").alias("item"),
            "fair",
            F.coalesce("imbuements", blank).alias("imbuements"),
            F.coalesce("delivery_npcs", blank).alias("delivery_npcs"),
            F.coalesce("delivery_bands", blank).alias("delivery_bands"),
            "npc_price",
        )
    )


def demand_marks(imbuing: DataFrame, delivery: DataFrame) -> DataFrame:
    """(item_key, tag): which kinds of demand an item has."""
    has = (
        imbuing.filter(F.coalesce(F.col("item"), F.lit("")) != "")
        .select(F.lower(F.trim("item")).alias("item_key"), F.lit(1).alias("i"), F.lit(0).alias("d"))
        .unionByName(delivery.select(F.lower("item").alias("item_key"), F.lit(0).alias("i"), F.lit(1).alias("d")))
        .groupBy("item_key")
        .agg(F.max("i").alias("i"), F.max("d").alias("d"))
    )
    tag = F.concat(
        F.when(F.col("i") == 1, IMBUING_MARK).otherwise(""), F.when(F.col("d") == 1, DELIVERY_MARK).otherwise("")
    )
    return has.select("item_key", tag.alias("tag"))


def demand_view(tags: DataFrame, kind: str = "all", order: str = "fair", search: str = "") -> DataFrame:
    """Items of one kind of demand, by price or name."""
    view = tags
    if kind == "imbuing":
        view = view.filter(F.col("imbuements") != "")
    elif kind == "delivery":
        view = view.filter(F.col("delivery_npcs") != "")
    if search:
        view = view.filter(F.lower("item").contains(search.lower()))
    by = [F.col("item")] if order == "name" else [F.coalesce(F.col("fair"), F.lit(0)).desc(), F.col("item")]
    return view.orderBy(*by)


def manual_prices(rows: DataFrame, version: tuple[str, ...]) -> DataFrame:
    """Highest price noted by hand: rows of side ``buy_max``, last one per item."""
    kept = rows.filter(F.col("side") == "buy_max")
    last = F.max_by("price_gp", F.struct(*version)).alias("price_gp")
    return kept.groupBy("item").agg(last).select("item", F.col("price_gp").cast("bigint"))


def monthly_volume(values: DataFrame) -> DataFrame:
    """Largest monthly volume of each item over the given captures."""
    volume = F.coalesce("month_sold", F.lit(0)) + F.coalesce("month_bought", F.lit(0))
    return values.groupBy("item_id").agg(F.max(volume).alias("volume"))


def refresh_by_volume(volumes: DataFrame, held: DataFrame, top: int, daily: int) -> DataFrame:
    """Items to refresh: the ``daily`` best by volume, and of the ``top`` best those not held yet."""
    order = [F.desc("volume"), F.col("item_id")]
    best = top_n(volumes.filter(F.col("item_id").isNotNull()), order, top, "position")
    missing = best.join(held.select("item_id"), "item_id", "left_anti").select("item_id", "volume", "position")
    return best.filter(F.col("position") <= daily).select("item_id", "volume", "position").unionByName(missing).distinct()


def quota_full(wanted: DataFrame, cap: int) -> DataFrame:
    """Items of a full capture: watched ones first, the others by name, up to ``cap``.

    ``wanted``: item_id, name, watched (1 or 0); an item wanted twice counts once, watched if any row is.
    """
    unique = wanted.groupBy("item_id").agg(F.max("watched").alias("watched"), F.min("name").alias("name"))
    order = [F.desc("watched"), F.col("name"), F.col("item_id")]
    return top_n(unique, order, cap, "position").select("item_id", "name", "watched", "position")


def quota_daily(full: DataFrame, volumes: DataFrame, cap: int) -> DataFrame:
    """Of a full capture's items those of a daily one: watched ones, then the most traded, up to ``cap``."""
    ranked = full.drop("position").join(volumes, "item_id", "left").withColumn("volume", F.coalesce("volume", F.lit(0)))
    order = [F.desc("watched"), F.when(F.col("watched") == 0, F.col("volume")).desc(), F.col("name"), F.col("item_id")]
    return top_n(ranked, order, cap, "position").select("item_id", "name", "watched", "volume", "position")


def quota_select(wanted: DataFrame, volumes: DataFrame, cap: int) -> DataFrame:
    """Items to capture within a quota: watched ones first, the rest by volume, then by name.

    ``wanted``: item_id, name, watched (1 or 0); an item wanted twice counts once, watched if any row is.
    """
    unique = wanted.groupBy("item_id").agg(F.max("watched").alias("watched"), F.min("name").alias("name"))
    ranked = unique.join(volumes, "item_id", "left").withColumn("volume", F.coalesce("volume", F.lit(0)))
    order = [F.desc("watched"), F.when(F.col("watched") == 0, F.col("volume")).desc(), F.col("name"), F.col("item_id")]
    return top_n(ranked, order, cap, "position").select("item_id", "name", "watched", "volume", "position")
