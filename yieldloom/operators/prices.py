"""Fair prices from order books.

A book is one row per offer: item_id, side ('sell' or 'buy'), price, units, anonymous, captured.
Every measure works on price levels (offers of one item, side and price folded together), so the size of
a popular item's book only matters in the partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import ratio
from ..session import save
from .latest import merge_latest
from .order_stats import known_levels, order_points

# Shares of the average price from which an offer counts as unfair, in percent.
UNFAIR_SELL, UNFAIR_BUY = 125, 75


def book_merge(snapshots: DataFrame, n: int = 7) -> DataFrame:
    """Books of the last n captures; an item's newest capture replaces its older ones.

    One row per item and capture with its offers in arrays, as captured.
    """
    return merge_latest(snapshots, ["item_id"], n)


def offers_of_books(books: DataFrame) -> DataFrame:
    """Offer rows of books with ``sellers`` and ``buyers`` arrays of STRUCT<name, price, amount>."""

    def side(column: str, name: str) -> DataFrame:
        return books.select("item_id", "update_time", F.explode(column).alias("o")).select(
            "item_id",
            F.lit(name).alias("side"),
            F.coalesce(F.col("o.price"), F.lit(0)).cast("bigint").alias("price"),
            F.coalesce(F.col("o.amount"), F.lit(0)).cast("bigint").alias("units"),
            F.coalesce(F.lower("o.name") == "anonymous", F.lit(False)).alias("anonymous"),
            F.timestamp_seconds(F.col("update_time").try_cast("double")).alias("captured"),
        )

    return side("sellers", "sell").unionByName(side("buyers", "buy"))


def reference_prices(averages: DataFrame) -> DataFrame:
    """Average per item and side: the day's, else the month's; 0 means missing."""

    def pick(day: str, month: str) -> Column:
        return F.coalesce(F.nullif(F.col(day), F.lit(0)), F.nullif(F.col(month), F.lit(0)), F.lit(0))

    return averages.select(
        "item_id",
        pick("day_average_sell", "month_average_sell").alias("avg_sell"),
        pick("day_average_buy", "month_average_buy").alias("avg_buy"),
    )


def named_rules(rules: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per-item rules keyed by lower-case item name -> keyed by item id, for every id of that name."""
    ids = metadata.select(F.lower("name").alias("name"), F.col("id").alias("item_id"))
    return rules.join(ids, "name").drop("name")


def price_by_name(prices: DataFrame) -> DataFrame:
    """One row per lower-case item name (``price_key``): of items that share a name the one with the greatest id."""
    named = prices.filter(F.col("item") != "").groupBy(F.lower("item").alias("price_key"))
    return named.agg(F.max_by(F.struct(*prices.columns), "item_id").alias("p")).select("price_key", "p.*")


def is_unfair() -> Column:
    """Far dearer than the average when selling, far cheaper when buying."""
    sell = (F.col("side") == "sell") & (F.col("avg_sell") > 0) & (F.col("price") * 100 >= F.col("avg_sell") * UNFAIR_SELL)
    buy = (F.col("side") == "buy") & (F.col("avg_buy") > 0) & (F.col("price") * 100 <= F.col("avg_buy") * UNFAIR_BUY)
    return F.coalesce(sell, F.lit(False)) | F.coalesce(buy, F.lit(False))


def judged_levels(
    offers: DataFrame, averages: DataFrame, rules: DataFrame, use_unfair: bool = True,
    exclude_anonymous: bool = False, max_sell_cap: int | None = None,
) -> DataFrame:
    """Price levels (item, side, price): offers and units kept, offers rejected, newest capture.

    ``rules`` overrides cap and anonymity per item through rows of item_id, has_cap, max_sell_cap,
    has_anon, exclude_anonymous. Offers fold together before any join.
    """
    anonymous = F.col("anonymous")
    levels = (
        offers.filter(F.col("price") > 0)
        .groupBy("item_id", "side", "price")
        .agg(
            F.count_if(~anonymous).alias("named"), F.count_if(anonymous).alias("hidden"),
            F.coalesce(F.sum(F.when(~anonymous, F.col("units"))), F.lit(0)).alias("named_units"),
            F.coalesce(F.sum(F.when(anonymous, F.col("units"))), F.lit(0)).alias("hidden_units"),
            F.max("captured").alias("captured"),
        )
    )
    cap = F.when(F.col("has_cap"), F.col("max_sell_cap")).otherwise(F.lit(max_sell_cap).cast("bigint"))
    hide = F.when(F.col("has_anon"), F.col("exclude_anonymous")).otherwise(F.lit(exclude_anonymous))
    over_cap = (F.col("side") == "sell") & (cap > 0) & (F.col("price") > cap)
    rejected = F.coalesce(over_cap, F.lit(False))
    if use_unfair:
        rejected = rejected | is_unfair()
    hide = F.coalesce(hide, F.lit(False))

    def kept(named: str, hidden: str) -> Column:
        return F.when(rejected, 0).otherwise(F.col(named) + F.when(hide, 0).otherwise(F.col(hidden)))

    return (
        levels.join(reference_prices(averages), "item_id", "left")
        .join(rules.select("item_id", "has_cap", "max_sell_cap", "has_anon", "exclude_anonymous"), "item_id", "left")
        .withColumn("offers", kept("named", "hidden"))
        .select(
            "item_id", "side", "price", "offers", kept("named_units", "hidden_units").alias("units"),
            (F.col("named") + F.col("hidden") - F.col("offers")).alias("rejected"), "captured",
        )
    )


def kept_ladder(judged: DataFrame) -> DataFrame:
    """Ladder of kept offers: units per item, side and price."""
    return judged.filter(F.col("offers") > 0).select("item_id", "side", "price", "units")


def offer_ladder(judged: DataFrame) -> DataFrame:
    """Ladder to publish: kept offers and their units per item, side and price."""
    return judged.filter(F.col("offers") > 0).select("item_id", "side", "price", "units", "offers")


def _fair(side_points: Column, total: Column, trim_bp: int) -> Column:
    """VWAP of what is left after the dearest ``trim_bp`` basis points of units are cut off."""
    left = total.cast("decimal(28,0)") * (10000 - trim_bp)
    inner = side_points["moment"].cast("decimal(33,0)") * 10000
    edge = side_points["value"].cast("decimal(19,0)") * (left - side_points["before"].cast("decimal(28,0)") * 10000)
    return F.when(left > 0, F.floor((inner + edge) / left).cast("bigint"))


def trimmed_vwap(ladder: DataFrame, trim_percent: float = 5.0) -> DataFrame:
    """Per item the buy VWAP without the dearest ``trim_percent`` of units, cut to a whole number."""
    marks = ladder_marks(ladder.filter(F.col("side") == "buy"), trim_percent)
    return marks.select("item_id", "fair").filter(F.col("fair").isNotNull())


def ladder_marks(ladder: DataFrame, trim_percent: float = 5.0, sell_percent: int = 25) -> DataFrame:
    """Per item ``fair`` (trimmed buy VWAP) and ``p25`` (quantile of the sell side), in one pass."""
    trim_bp = round(trim_percent * 100)
    trim_bp = 0 if trim_bp >= 10000 else trim_bp  # nothing left to average: use the whole book
    keys = ["item_id", "side"]
    points = order_points(
        known_levels(ladder, keys, F.col("price"), F.col("units")),
        keys,
        lambda total, rows: {
            "mark": F.when(F.col("side") == "buy", F.ceil(total * (10000 - trim_bp) / 10000)).otherwise(
                F.ceil(total * sell_percent / 100)
            )
        },
        moment=True,
    )
    buy, sell = F.col("side") == "buy", F.col("side") == "sell"
    return points.groupBy("item_id").agg(
        F.max(F.when(buy, _fair(F.col("mark"), F.col("total"), trim_bp))).alias("fair"),
        F.max(F.when(sell, F.col("mark.value"))).alias("p25"),
    )


def shelf_levels(ladder: DataFrame) -> DataFrame:
    """Per item the sell level with most units (of equal ones the cheapest)."""
    return (
        ladder.filter(F.col("side") == "sell")
        .groupBy("item_id")
        .agg(F.max(F.struct("units", (-F.col("price")).alias("neg"))).alias("s"))
        .select("item_id", (-F.col("s.neg")).alias("shelf_level"), F.col("s.units").alias("shelf_units"))
    )


def _whole_vwap(near: Column) -> Column:
    """Whole-number VWAP over the levels a condition selects."""
    worth = F.sum(F.when(near, F.col("price").cast("decimal(19,0)") * F.col("units").cast("decimal(18,0)")))
    return F.floor(F.try_divide(worth, F.sum(F.when(near, F.col("units"))))).cast("bigint")


def _near_shelf() -> Column:
    return (F.col("side") == "sell") & (F.abs(F.col("price") - F.col("shelf_level")) * 100 <= F.col("shelf_level"))


def _near_fair() -> Column:
    return (F.col("price") * 10).between(F.col("fair") * 9, F.col("fair") * 11)


def shelf_price(ladder: DataFrame) -> DataFrame:
    """Per item the VWAP of sells within 1 % of the fullest sell level, and that level's units."""
    shelves = shelf_levels(ladder)
    return (
        ladder.filter(F.col("side") == "sell").join(shelves, "item_id").groupBy("item_id")
        .agg(_whole_vwap(_near_shelf()).alias("shelf"), F.max("shelf_units").alias("shelf_units"))
    )


def depth_band(ladder: DataFrame, fair: DataFrame) -> DataFrame:
    """Units on both sides within 10 % of the fair price."""
    return (
        ladder.join(fair.filter(F.col("fair") != 0).select("item_id", "fair"), "item_id").groupBy("item_id")
        .agg(F.coalesce(F.sum(F.when(_near_fair(), F.col("units"))), F.lit(0)).alias("depth_units"))
    )


def price_stats(
    offers: DataFrame, averages: DataFrame, rules: DataFrame, metadata: DataFrame | None = None,
    trim_percent: float = 5.0, use_unfair: bool = True, exclude_anonymous: bool = False,
    max_sell_cap: int | None = None,
) -> DataFrame:
    """All price measures per item that has at least one kept offer."""
    judged = judged_levels(offers, averages, rules, use_unfair, exclude_anonymous, max_sell_cap)
    return price_measures(save(judged, "price-levels"), metadata, trim_percent)


def price_measures(judged: DataFrame, metadata: DataFrame | None = None, trim_percent: float = 5.0) -> DataFrame:
    """``price_stats`` of saved judged levels. They are read several times, so save them first."""
    sell, buy, kept = F.col("side") == "sell", F.col("side") == "buy", F.col("offers") > 0
    basics = judged.groupBy("item_id").agg(
        F.min(F.when(kept & sell, F.col("price"))).alias("patient"),
        F.max(F.when(kept & buy, F.col("price"))).alias("top_buy"),
        F.coalesce(F.sum(F.when(sell, F.col("offers"))), F.lit(0)).alias("n_sell"),
        F.coalesce(F.sum(F.when(buy, F.col("offers"))), F.lit(0)).alias("n_buy"),
        F.coalesce(F.sum(F.when(sell, F.col("rejected"))), F.lit(0)).alias("n_sell_red"),
        F.max("captured").alias("captured"),
    ).filter((F.col("n_sell") > 0) | (F.col("n_buy") > 0))

    ladder = kept_ladder(judged)
    facts = ladder_marks(ladder, trim_percent).join(shelf_levels(ladder), "item_id", "full_outer")
    measured = ladder.join(facts, "item_id").groupBy("item_id").agg(
        F.max("fair").alias("fair"),
        F.max("p25").alias("p25"),
        _whole_vwap(_near_shelf()).alias("shelf"),
        F.max("shelf_units").alias("shelf_units"),
        F.when(
            F.max("fair") != 0, F.coalesce(F.sum(F.when(_near_fair(), F.col("units"))), F.lit(0))
        ).alias("depth_units"),
    )
    stats = basics.join(measured, "item_id", "left").select(
        "item_id",
        (F.col("patient") - 1).alias("instant"),
        "top_buy", "fair", "shelf", "shelf_units", "patient",
        ratio(F.col("p25") - F.col("fair"), F.col("fair"), 3).alias("upside"),
        "depth_units", "n_sell", "n_buy", "n_sell_red",
        F.date_format("captured", "yyyy-MM-dd HH:mm").alias("captured_at"),
    )
    if metadata is None:
        return stats
    names = metadata.select(F.col("id").alias("item_id"), F.col("name").alias("item"))
    return stats.join(names, "item_id", "left")


def history_daily(history: DataFrame) -> DataFrame:
    """Per item and day the last snapshot's average prices; offers stand in for missing averages."""
    rows = history.select(
        "item_id",
        F.to_date(F.timestamp_seconds(F.col("time").try_cast("double"))).alias("date"),
        "time",
        F.coalesce("day_average_buy", "buy_offer").alias("buy"),
        F.coalesce("day_average_sell", "sell_offer").alias("sell"),
    )
    last = F.max_by(F.struct("buy", "sell"), F.struct("time", "buy", "sell")).alias("s")
    return rows.groupBy("item_id", "date").agg(last).select("item_id", "date", "s.buy", "s.sell")
