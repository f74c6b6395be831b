"""The gold build: from dated snapshots and reference lists to all result tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import consensus, demand, events, kills, prices, sessions
from ..operators.latest import latest_by_key
from ..session import save, save_counted
from ..sources import documents, sinks, snapshots

OFFER_SIDE = "array<struct<name:string,price:bigint,amount:bigint>>"
BOOK = f"struct<sellers:{OFFER_SIDE},buyers:{OFFER_SIDE},update_time:double>"
CREATURE = "struct<experience_points:bigint,loot_list:array<string>,hitpoints:bigint>"
SNAPSHOT = "struct<time:double,day_average_buy:bigint,day_average_sell:bigint,buy_offer:bigint,sell_offer:bigint>"
AVERAGES = (
    "id bigint, buy_offer bigint, sell_offer bigint, day_average_buy bigint, day_average_sell bigint, "
    "month_average_buy bigint, month_average_sell bigint, month_sold bigint, month_bought bigint"
)
METADATA = "id bigint, name string, category string"
RULES = "item_id bigint, has_cap boolean, max_sell_cap bigint, has_anon boolean, exclude_anonymous boolean"
GUIDES = (
    "spawn string, bracket string, exp_lo string, exp_hi string, profit_lo string, profit_hi string, "
    "source string, source_date string, note string"
)
CLAIMS = "block string, url string, date string, spawn string, lvl string, voc string, exp_h string, profit_h string, note string"


@dataclass
class Settings:
    """Parameters of a run; ``as_of`` stands for today."""

    as_of: dt.date
    min_year: int = 2026
    profit_days: int = 60
    exp_days: int = 365
    brackets: Sequence[tuple[int, int]] = sessions.BRACKETS
    extra_event_days: Sequence[str] = ()
    trim_percent: float = 5.0
    use_unfair_filter: bool = True
    exclude_anonymous: bool = False
    max_sell_cap: int | None = None
    item_rules: dict[str, dict] = field(default_factory=dict)  # lower-case item name -> overrides


@dataclass
class Silver:
    """Cleaned inputs of a build."""

    sessions: DataFrame
    all_sessions: DataFrame
    kills: DataFrame
    offers: DataFrame
    averages: DataFrame
    metadata: DataFrame
    creature_items: DataFrame
    history: DataFrame
    imbuing: DataFrame
    delivery: DataFrame
    manual: DataFrame
    guides: DataFrame
    claims: DataFrame
    event_days: DataFrame


def _rows_of_maps(spark, root, file, value, key, n=None):
    """Rows of the map documents of a snapshot file: the last n captures, or the newest only."""
    rows = snapshots.read_map_snapshots(spark, root, file, value, key, n or 1)
    return rows if n is None else latest_by_key(rows, [key])


def read_silver(spark: SparkSession, root: str, reference: str, research: str, world: str, s: Settings) -> Silver:
    """Read snapshots below ``root`` and the lists below ``reference`` and ``research``.

    Snapshot files are required; lists may be missing.
    """
    books = _rows_of_maps(spark, root, f"orderbook_{world}.json", BOOK, "item_id", 7)
    books = books.withColumn("item_id", F.col("item_id").try_cast("bigint"))
    averages = snapshots.read_json_snapshots(spark, root, f"market_values_{world}.json", AVERAGES, 1)
    metadata = snapshots.read_json_snapshots(spark, root, "market_metadata_all.json", METADATA, 1)
    creatures = _rows_of_maps(spark, root, "creatures.json", CREATURE, "creature")
    history = snapshots.read_map_snapshots(spark, root, "market_history_top.json", f"array<{SNAPSHOT}>", "item_id", 1)
    history = history.select("item_id", F.col("record").alias("rows"))
    news = snapshots.read_json_snapshots(spark, root, "events.json", "date string, name string")

    def listed(path: str, schema: str) -> DataFrame:
        return documents.read_optional_csv(spark, path, schema)

    delivery = demand.delivery_rows(
        listed(f"{reference}/delivery_npc.csv", "item string, npc string, npc_price string, market_band string"),
        listed(f"{reference}/delivery_items.csv", "item string, creatures string, npc string, npc_price string, qty string"),
    )
    manual = listed(f"{reference}/manual/*.csv", "item string, side string, price_gp bigint, note string, source string, date string")
    claims_path = f"{research}/blocks/*/claims.jsonl"
    return Silver(
        sessions=snapshots.recent_sessions_of(spark, root),
        all_sessions=snapshots.all_sessions_of(spark, root).select("id", "spawn"),
        kills=snapshots.recent_kills_of(spark, root),
        offers=prices.offers_of_books(books),
        averages=latest_by_key(averages.withColumnRenamed("id", "item_id"), ["item_id"]),
        # One row per id; lookups by name fold ids that share one.
        metadata=metadata.filter("id is not null and name <> ''").groupBy("id").agg(F.max("name").alias("name")),
        creature_items=creatures.select("creature", F.explode("loot_list").alias("item")),
        history=history.select(F.col("item_id").try_cast("bigint").alias("item_id"), F.inline("rows")),
        imbuing=listed(f"{reference}/imbuing_items.csv", "item string, imbuement string, tier string, qty string"),
        delivery=delivery,
        manual=demand.manual_prices(manual, ("date", "price_gp")),
        guides=listed(f"{research}/control_estimates.csv", GUIDES),
        claims=(
            documents.read_json_lines(spark, claims_path, CLAIMS)
            if documents.path_exists(spark, claims_path)
            else spark.createDataFrame([], CLAIMS)
        ),
        event_days=events.known_event_days(news, s.extra_event_days),
    )


def item_rules(silver: Silver, s: Settings) -> DataFrame:
    """Per-item price rules of the settings, keyed by item id."""
    rows = [
        (name, "max_sell_cap" in r, r.get("max_sell_cap"), "exclude_anonymous" in r, r.get("exclude_anonymous"))
        for name, r in s.item_rules.items()
    ]
    spark = silver.metadata.sparkSession
    schema = RULES.replace("item_id bigint", "name string")
    return prices.named_rules(spark.createDataFrame(rows, schema), silver.metadata)


def build_tables(silver: Silver, s: Settings) -> dict[str, DataFrame]:
    """All gold tables. Brackets are a column; the tag ``all`` is the overall view."""
    as_of = F.lit(s.as_of)
    tags = sessions.bracket_tags(s.brackets)
    dated = sessions.year_floor(silver.sessions, F.year("hunt_date"), s.min_year, keep_undated=True)
    event_days, n_event_days = save_counted(silver.event_days, "event-days")
    manual, n_manual = save_counted(silver.manual, "manual-prices")
    widest = save(sessions.flag_events(sessions.recent(dated, as_of, max(s.exp_days, s.profit_days)), event_days), "sessions")
    usable = widest.filter("event_flag = 0")
    exp = sessions.recent(usable, as_of, s.exp_days)
    profit = sessions.recent(usable, as_of, s.profit_days)
    kill_rows = save(silver.kills, "kills")

    judged = prices.judged_levels(
        silver.offers, silver.averages, item_rules(silver, s), s.use_unfair_filter, s.exclude_anonymous, s.max_sell_cap
    )
    judged = save(judged, "price-levels")
    price_table, n_prices = save_counted(prices.price_measures(judged, silver.metadata, s.trim_percent), "prices")
    tags_table, n_tags = save_counted(demand.item_tags(silver.imbuing, silver.delivery, price_table), "item-tags")

    calibration = kills.calibration_sessions(usable, as_of)
    values = save(kills.value_per_kill(calibration, kill_rows), "values")
    fresh = F.col("hunt_date") >= F.date_sub(as_of, s.profit_days)
    profit_table = save(
        kills.spawn_profit(
            sessions.with_bracket_sets(calibration, brackets=s.brackets, when=fresh), kill_rows, values
        ),
        "spawn-profit",
    )
    stats = save(
        sessions.spawn_stats(sessions.with_brackets(profit, brackets=s.brackets), ("bracket", "spawn")), "spawn-stats"
    )
    rows = consensus.evidence(profit_table, stats, silver.guides, silver.claims, as_of, s.min_year, tags)
    compared, members = consensus.profit_compare(rows)
    places, n_places = save_counted(
        kills.spawn_items(silver.all_sessions, kill_rows, silver.creature_items, price_table, silver.metadata), "spawn-items"
    )
    ranked = {
        f"ranking_{name}": sessions.top_sessions(sessions.with_brackets(df, brackets=s.brackets), metric)
        for name, df, metric in (("exp", exp, "xp_h"), ("profit", profit, "loot_h"))
    }
    return {
        **ranked,
        "price_stats": price_table,
        "ladder": prices.offer_ladder(judged),
        "history": prices.history_daily(silver.history),
        "item_tags": tags_table,
        "spawn_items": places,
        "hunt_kills_h": kills.kills_enriched(kill_rows, usable),
        "creature_value": values,
        "spawn_profit": profit_table,
        "missing_values": kills.missing_values(
            sessions.with_bracket_sets(calibration, brackets=s.brackets, when=fresh), kill_rows, values
        ),
        "spawn_loot": kills.spawn_loot(
            calibration, kill_rows, silver.creature_items, values, price_table,
            demand.demand_marks(silver.imbuing, silver.delivery),
        ),
        "spawn_stats": stats,
        "profit_compare": compared,
        "cluster_members": members,
        "profit_consensus": consensus.consensus(compared),
        "build_info": sessions.run_metrics(
            widest, as_of, s.exp_days, s.profit_days, price_items=n_prices, spawn_items=n_places, tagged_items=n_tags,
            events_days=n_event_days, manual_prices=n_manual,
        ),
        "manual_prices": manual,
    }


def write_tables(tables: dict[str, DataFrame], out: str, fmt: str = "parquet") -> None:
    """Write every table below ``out``; the ladder is clustered by item for single-item reads."""
    for name, df in tables.items():
        if name == "ladder":
            sinks.write_ladder(df, f"{out}/{name}")
        else:
            sinks.write_gold(df, f"{out}/{name}", df.columns, "bracket" if "bracket" in df.columns else None, fmt=fmt)
