"""Kills joined to sessions: rates, shares, calibrated value per kill, computed spawn profit, loot tables.

Kills are expected at one row per session and creature (``latest_by_key`` over captures gives that).
Rates and contributions are added up as whole billionths, so results do not depend on row order.
Joins by session or creature are dealt out by that key (``merge``): both sides grow with the input, and a side whose file
is small is still large in memory, so none is gathered in the driver to be sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rates import per_hour, ratio
from ..session import save
from .names import resolve_names
from .prices import price_by_name
from .order_stats import exact_median, half_of_shares, order_points, share_weight, value_levels
from .topk import first_values, joined, top_per_group

CALIBRATION_DAYS = 120
MIN_MINUTES = 15
_BILLION = 1_000_000_000


def kills_enriched(kills: DataFrame, sessions: DataFrame) -> DataFrame:
    """Kills with their session's place, date and rates, and the kill rate."""
    s = sessions.select(
        F.col("id").alias("hunt_id"), "spawn", "hunt_date", "minutes", "xp_h", "loot_h", "balance_h", "url"
    )
    return kills.join(s, "hunt_id").select(
        "hunt_id", "spawn", "hunt_date", "minutes", "creature", "killed",
        per_hour(F.col("killed"), F.col("minutes")).alias("kills_per_h"),
        "xp_h", "loot_h", "balance_h", "url",
    )


def bracket_kills(kills: DataFrame, sessions: DataFrame) -> DataFrame:
    """Kills of the given sessions."""
    ids = sessions.select(F.col("id").alias("hunt_id")).distinct()
    return kills.join(ids, "hunt_id", "left_semi").select(*kills.columns)


def session_totals(kills: DataFrame) -> DataFrame:
    """Kills with their session's ``total``. Rows that are dealt by session are not dealt again."""
    total = F.sum("killed").over(Window.partitionBy("hunt_id"))
    return kills.filter(F.col("killed") > 0).withColumn("total", total)


def kill_share(kills: DataFrame) -> DataFrame:
    """Each creature's share of its session's kills. Rows that are dealt by session are not dealt again."""
    total = F.sum("killed").over(Window.partitionBy("hunt_id"))
    return kills.filter(F.col("killed") > 0).select("hunt_id", "creature", "killed", (F.col("killed") / total).alias("share"))


def calibration_sessions(sessions: DataFrame, as_of: Column, days: int = CALIBRATION_DAYS) -> DataFrame:
    """Sessions recent and long enough to calibrate on; one from today counts."""
    return sessions.filter(
        F.col("hunt_date").between(F.date_sub(as_of, days), as_of) & (F.col("minutes") >= MIN_MINUTES)
    )


def value_per_kill(calibration: DataFrame, kills: DataFrame) -> DataFrame:
    """Per creature what one kill is worth: weighted median over sessions, weighted by kill share.

    A session's loot per hour split by kill share and divided by the kill rate is the same for each of
    its creatures: loot_h * minutes / (60 * all kills). Values are cut to whole numbers first; as cutting
    keeps their order, the median's cut value is the same.
    """
    s = calibration.filter(F.col("loot_h") > 0).select(F.col("id").alias("hunt_id"), "loot_h", "minutes", "url")
    # The long kill table is read once; the recent part of it is all the steps below need. The join leaves it dealt by
    # session, so a session's total is added up there and nothing is dealt again for it.
    recent = save(session_totals(kills.join(s.hint("merge"), "hunt_id")), "recent-kills")
    worth = F.col("loot_h") * F.col("minutes") / (F.col("total") * 60.0)
    seen = recent.select(
        "creature", "hunt_id", "url", worth.cast("bigint").alias("v"),
        share_weight(F.col("killed") / F.col("total")).alias("w"),
    )
    levels = value_levels(seen, ["creature"], F.col("v"), F.col("w"))
    middle = order_points(
        levels, ["creature"], lambda total, rows: {"half": half_of_shares(total, rows)}, extremes=True
    )
    samples = joined(
        top_per_group(seen.select("creature", "hunt_id", "url"), ["creature"], [F.col("hunt_id")], 5),
        ["creature"], "url", "|", "sample_urls",
    )
    return (
        middle.join(samples.hint("merge"), "creature")
        .select(
            "creature", F.col("total_rows").alias("n_sessions"),
            F.col("half.value").alias("value_per_kill"),
            F.col("least").alias("min_v"),
            F.col("greatest").alias("max_v"),
            "sample_urls",
        )
    )


def _rates(kills: DataFrame, sessions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Kill rates in billionths per hour, for sessions with kills and enough minutes."""
    s = sessions.filter(F.col("minutes") >= MIN_MINUTES).select(
        *keys, F.col("id").alias("hunt_id"), "minutes", "loot_h"
    )
    rate = F.round(F.col("killed") * (60.0 * _BILLION) / F.col("minutes"), 0).cast("decimal(18,0)")
    return kills.filter(F.col("killed") > 0).join(s.hint("merge"), "hunt_id").select(
        *keys, "creature", "hunt_id", "loot_h", rate.alias("rate")
    )


def _mean_rates(folded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean rate per creature over the sessions where it occurs, from rates folded by ``_folded``."""
    return (
        folded.groupBy(*keys, "creature")
        .agg(F.sum("rate_sum").alias("rate_sum"), F.sum("n_sessions").alias("n_sessions"))
        .withColumn("avg_rate", F.expr("cast((2 * rate_sum + n_sessions) div (2 * n_sessions) as bigint)"))
        .drop("rate_sum")
    )


def _folded(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rates.groupBy(*keys, "creature").agg(F.sum("rate").alias("rate_sum"), F.count(F.lit(1)).alias("n_sessions"))


def spawn_rates(sessions: DataFrame, kills: DataFrame, values: DataFrame) -> DataFrame:
    """Mean kill rate of each spawn, bracket and creature, with the value of a kill where it is known."""
    folded = _folded(_rates(kills, sessions, ["brackets", "spawn"]), ["brackets", "spawn"])
    per = _mean_rates(folded.withColumn("bracket", F.explode("brackets")), ["bracket", "spawn"])
    return per.join(values.select("creature", "value_per_kill").hint("merge"), "creature", "left")


def missing_values(sessions: DataFrame, kills: DataFrame, values: DataFrame) -> DataFrame:
    """The gaps as a table: every creature without a value, by spawn and bracket, with its mean kill rate."""
    gaps = spawn_rates(sessions, kills, values).filter(F.col("value_per_kill").isNull())
    return gaps.select("bracket", "spawn", "creature", ratio(F.col("avg_rate"), F.lit(_BILLION), 1).alias("avg_kills_h"))


def spawn_profit(sessions: DataFrame, kills: DataFrame, values: DataFrame) -> DataFrame:
    """Computed profit per hour of each spawn and bracket: mean kill rate times value per kill, summed over creatures.

    ``sessions`` has one row per session with its list of ``brackets``. Kills are folded per set of brackets, and only
    what is folded is counted in each bracket of the set. ``coverage`` is the valued part of the kill rate; creatures
    without a value are listed, not guessed. The measured median over the same sessions stands beside it.
    """
    keys = ["bracket", "spawn"]
    per = save(spawn_rates(sessions, kills, values), "spawn-rates")
    valued = F.col("value_per_kill").isNotNull()
    amount = F.col("avg_rate").cast("decimal(19,0)") * F.col("value_per_kill").cast("decimal(18,0)")
    totals = per.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(valued, amount)), F.lit(0)).alias("profit"),
        F.coalesce(F.sum(F.when(valued, F.col("avg_rate"))), F.lit(0)).alias("valued_rate"),
        F.sum("avg_rate").alias("all_rate"),
    )
    valued_text = F.format_string(
        "%s %d/h×%d", "creature", ratio(F.col("avg_rate"), F.lit(_BILLION), 0).cast("bigint"), "value_per_kill"
    )
    listed = top_per_group(
        per.select(*keys, valued.alias("known"), F.when(valued, valued_text).otherwise(F.col("creature")).alias("text")),
        [*keys, "known"], [F.col("text")], 10,
    )

    def texts(known: bool, separator: str) -> Column:
        mine = F.when(F.col("known") == known, F.struct("rank", "text"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(mine)), lambda p: p["text"]), separator)

    lists = listed.groupBy(*keys).agg(texts(True, ";").alias("valued"), texts(False, "|").alias("missing"))
    killing = kills.filter(F.col("killed") > 0).select(F.col("hunt_id").alias("id"))
    hunts = sessions.filter(F.col("minutes") >= MIN_MINUTES).join(killing.hint("merge"), "id", "left_semi")
    hunts = hunts.select("spawn", "id", "loot_h", F.explode("brackets").alias("bracket"))
    counted = hunts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sessions"))
    measured = exact_median(hunts.filter(F.col("loot_h") != 0), keys, F.col("loot_h"), "measured_loot_h")
    return (
        totals.join(counted, keys)
        .join(measured, keys, "left")
        .join(lists, keys)
        .select(
            *keys,
            F.expr(f"profit div {_BILLION}").alias("profit_computed_h"),
            F.coalesce(ratio(F.col("valued_rate"), F.col("all_rate"), 2), F.lit(0.0)).alias("coverage"),
            "n_sessions",
            "measured_loot_h",
            "valued",
            "missing",
        )
    )


def spawn_loot(
    calibration: DataFrame, kills: DataFrame, creature_items: DataFrame, values: DataFrame,
    prices: DataFrame, tags: DataFrame,
) -> DataFrame:
    """Per spawn and creature: mean kill rate, value, contribution per hour and its four dearest items."""
    rates = _rates(kills, calibration.filter(F.col("spawn") != ""), ["spawn"])
    top = top_loot(creature_items, prices, tags)
    return (
        _mean_rates(_folded(rates, ["spawn"]), ["spawn"])
        .join(values.select("creature", "value_per_kill"), "creature", "left")
        .join(top, "creature", "left")
        .select(
            "spawn", "creature",
            ratio(F.col("avg_rate"), F.lit(_BILLION), 1).alias("avg_kills_h"),
            "n_sessions", "value_per_kill",
            F.expr(
                f"(cast(avg_rate as decimal(19,0)) * cast(value_per_kill as decimal(18,0))) div {_BILLION}"
            ).alias("contrib_h"),
            "top_loot",
        )
    )


def top_loot(creature_items: DataFrame, prices: DataFrame, tags: DataFrame, k: int = 4) -> DataFrame:
    """Per creature its k dearest items as ``item|price|tag`` texts."""
    items = creature_items.select("item").distinct().withColumn("item_key", F.lower("item"))
    priced = resolve_names(items, "item_key", price_by_name(prices), "price_key", ["fair"])
    tagged = priced.join(tags.select(F.col("item_key"), "tag"), "item_key", "left")
    text = F.concat_ws(
        "|", "item", F.coalesce(F.col("fair").cast("string"), F.lit("—")), F.coalesce("tag", F.lit(""))
    )
    labelled = tagged.select("item", F.coalesce("fair", F.lit(-1)).alias("worth"), text.alias("text"))
    ranked = top_per_group(
        creature_items.select("creature", "item").distinct().join(labelled, "item"),
        ["creature"], [F.desc("worth"), F.desc("item")], k,
    )
    return joined(ranked, ["creature"], "text", "|", "top_loot")


def spawn_items(
    sessions: DataFrame, kills: DataFrame, creature_items: DataFrame, prices: DataFrame, metadata: DataFrame
) -> DataFrame:
    """What drops where: items of the creatures met at a spawn, with prices and the first six creatures.

    Kills meet their places once: one fold gives both the creatures and the sessions of each spawn.
    """
    place = sessions.filter(F.coalesce(F.col("spawn"), F.lit("")) != "").select(F.col("id").alias("hunt_id"), "spawn")
    placed = kills.select("hunt_id", "creature").join(place, "hunt_id")
    folded = save(
        placed.groupingSets([["spawn", "creature"], ["spawn", "hunt_id"]], "spawn", "creature", "hunt_id").agg(F.grouping("hunt_id").alias("by_creature")),
        "spawn-kills",
    )
    met = folded.filter("by_creature = 1").select("spawn", "creature")
    n_sessions = folded.filter("by_creature = 0").groupBy("spawn").agg(F.count(F.lit(1)).alias("n_sessions_spawn"))
    drops = (
        met
        .join(creature_items.select("creature", "item").distinct(), "creature")
    )
    creatures = first_values(drops, ["spawn", "item"], "creature", 6, "|", "creatures")

    price_cols = ["instant", "fair", "patient", "captured_at"]
    priced = price_by_name(prices).select("price_key", *price_cols)
    items = creature_items.select("item").distinct().withColumn("item_key", F.lower("item"))
    named = resolve_names(items, "item_key", metadata.withColumn("meta_key", F.lower("name")), "meta_key", ["id", "meta_key"])
    own = priced.select(F.col("price_key").alias("own_key"), F.struct(*price_cols).alias("own"))
    via = priced.select(F.col("price_key").alias("via_key"), F.struct(*price_cols).alias("via"))
    facts = (
        named.join(own, F.col("item_key") == F.col("own_key"), "left")
        .join(via, F.col("meta_key") == F.col("via_key"), "left")
        .withColumn("p", F.coalesce("own", "via"))
        .select("item", F.col("id").alias("item_id"), "p.instant", "p.fair", "p.patient", F.col("p.captured_at").alias("price_date"))
    )
    return (
        creatures.join(n_sessions, "spawn")
        .join(facts, "item", "left")
        .select("spawn", "item", "item_id", "instant", "fair", "patient", "price_date", "n_sessions_spawn", "creatures")
    )
