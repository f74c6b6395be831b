"""Registered queries: every operator on the driver's tables. Dates leave as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.content import content_score
from ..functions.names import canon_tokens, norm_name
from ..functions.rates import bracket_middle, confidence_band, loot_per_hour, party_size_of, per_hour
from ..functions.text import digits_only as text_digits
from ..functions.text import (
    epoch_text, event_days, first_number, lenient_int, parse_duration, parse_money_range, parse_session_date, year_of,
)
from ..operators import consensus as con
from ..operators import capture, content, demand, events, extract, kills, latest, names, order_stats, prices, sessions, targets, topk
from ..session import fresh_path, save, save_counted
from ..sources import documents, keyed_store, sinks, snapshots
from ..sources.capture_store import CaptureStore
from ..sources.lookup_cache import LookupCache
from ..streaming import incremental
from .domain import EXP_DAYS, MIN_YEAR, PROFIT_DAYS, Domain

QUERIES: dict[str, Callable[[Domain], DataFrame]] = {}


def query(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _long(*columns: str) -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# ---- sources and captures -----------------------------------------------------------------------


def _event_captures(d: Domain) -> DataFrame:
    return d.table("events").withColumn("capture_date", F.to_date("ts"))


@query
def snapshot_window(d):
    """Last 14 captures, newest row per user."""
    rows = latest.last_captures(_event_captures(d), 14)
    newest = latest.latest_by_key(rows, ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value", _day("capture_date"))


@query
def json_snapshots(d):
    """One JSON document per year as dated snapshots: the newest three are read, the others stay closed."""
    root = fresh_path(d.spark, "json-snapshots")
    years = d.table("orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))
    texts = years.select(F.concat("year", F.lit("-12-31")).alias("capture_date"), F.to_json(F.struct("year", "orders")).alias("value"))
    texts.write.partitionBy("capture_date").text(root)
    read = snapshots.read_json_snapshots(d.spark, root, "part-*", "year bigint, orders bigint", 3)
    return read.select("year", "orders", _day("capture_date"))


def _year_documents(d: Domain, opening: str, closing: str, record: Column) -> str:
    """A document of one year's orders each, lines of records between brackets; their folder."""
    root, year = fresh_path(d.spark, "year-documents"), F.year("o_orderdate")
    rows = d.table("orders").select(F.concat(year, F.lit("-12-31")).alias("capture_date"), "o_orderkey", record.alias("record"))
    ends = rows.groupBy("capture_date").agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    lines = rows.join(ends, "capture_date").select(
        "capture_date", "o_orderkey",
        F.concat(
            F.when(F.col("o_orderkey") == F.col("low"), opening).otherwise(""), "record",
            F.when(F.col("o_orderkey") == F.col("high"), closing).otherwise(","),
        ).alias("value"),
    )
    # A document is one file, so a year is written by one task; it is read by as many as it has splits.
    lines.repartition("capture_date").sortWithinPartitions("capture_date", "o_orderkey").drop("o_orderkey").write.partitionBy("capture_date").text(root)
    return root


def _noted() -> Column:
    """Text with what a reader of splits could stumble over: quotes, commas, brackets and backslashes inside strings."""
    return F.concat(F.lit('", [{'), F.col("o_orderpriority"), F.lit("\\"))


@query
def json_map_records(d):
    """Every year's orders as one JSON map document; of all documents each record is a row."""
    fields = F.struct(F.floor("o_totalprice").alias("total"), _noted().alias("note"), F.array("o_orderstatus", F.lit("},")).alias("tags"))
    root = _year_documents(d, "{", "}", F.concat(F.lit('"'), F.col("o_orderkey"), F.lit('": '), F.to_json(fields)))
    rows = snapshots.read_map_snapshots(d.spark, root, "part-*", "struct<total:bigint,note:string,tags:array<string>>")
    return rows.select("key", "total", "note", F.element_at("tags", 1).alias("status"), _day("capture_date"))


@query
def json_array_records(d):
    """Every year's orders as one JSON array document, the newest three years read."""
    fields = F.struct(F.col("o_orderkey").alias("id"), _noted().alias("note"))
    root = _year_documents(d, "[", "]", F.to_json(fields))
    rows = snapshots.read_json_snapshots(d.spark, root, "part-*", "id bigint, note string", 3)
    return rows.select("id", "note", _day("capture_date"))


@query
def guide_list(d):
    """The guide list written as CSV and read back as an optional list; a missing one is empty."""
    path, schema = fresh_path(d.spark, "guides"), "spawn string, bracket string, profit_lo string, profit_hi string, source string, source_date string"
    columns = [c.split()[0] for c in schema.split(", ")]
    d.guides().select(*columns).write.option("header", True).csv(path)
    lists = [documents.read_optional_csv(d.spark, p, schema) for p in (path, f"{path}-missing")]
    rows = lists[0].unionByName(lists[1])
    numbers = [F.col(c).try_cast("bigint").alias(c) for c in ("profit_lo", "profit_hi")]
    return rows.select("spawn", F.replace(F.col("bracket"), F.lit("-"), F.lit("_")).alias("bracket"), *numbers, "source", "source_date")


@query
def snapshot_all_latest(d):
    """All captures, newest row per user."""
    newest = latest.latest_by_key(_event_captures(d), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value", _day("capture_date"))


@query
def snapshot_latest(d):
    """Rows of the newest capture."""
    return latest.latest_capture(_event_captures(d)).select("event_id", "user_id", "event_type", _day("capture_date"))


@query
def latest_by_key(d):
    return latest.latest_by_key(d.session_captures(), ["id"]).select("id", "spawn", "loot_h", _day("capture_date"))


@query
def capture_merge(d):
    """A later capture replaces the sessions it holds."""
    rows = d.session_captures()
    old = rows.filter(F.col("capture_date") == "2026-01-01")
    new = rows.filter((F.col("capture_date") == "2026-01-02") & (F.col("loot_h") > 100000))
    return latest.replace_rows(old, new, "id").select("id", "spawn", "loot_h", _day("capture_date"))


def _captured(d: Domain, first: DataFrame, keep: Column, more: int) -> dict[str, DataFrame]:
    """Sessions of a capture with their kills, numbers raised by ``more``. ``first``: all sessions as captured first."""
    rows = first.filter(keep)
    kills = d.kills().select("hunt_id", "creature", (F.col("killed") + more).alias("killed"))
    if more:
        kills = kills.filter(F.length("creature") % 2 == 0)
    return {"sessions": rows.select("id", "spawn", (F.col("loot_h") + more).alias("loot_h")), "kills": kills}


@query
def capture_append(d):
    """Two captures in a store; a later one is added to the second day: its sessions replace theirs with all their kills.

    The same rows are added once more, which changes nothing. Kills of sessions that were not captured are left out.
    """
    tables = {"sessions": "id string, spawn string, loot_h bigint", "kills": "hunt_id string, creature string, killed bigint"}
    store = CaptureStore(d.spark, fresh_path(d.spark, "captures"), tables)
    number = F.col("id").cast("bigint")
    first = save(d.session_captures().filter(F.col("capture_date") == "2026-01-01").select("id", "spawn", "loot_h"), "first-capture")
    store.append("2026-01-01", _captured(d, first, number % 3 == 0, 0))
    store.append("2026-01-02", _captured(d, first, number % 2 == 0, 0))
    later = {t: save(rows, "later-capture") for t, rows in _captured(d, first, number % 5 == 0, 7).items()}
    for _ in range(2):
        store.append("2026-01-02", later)
    kills = store.read("kills").groupBy(F.col("hunt_id").alias("id"), "capture_date").agg(
        F.count(F.lit(1)).alias("creatures"), F.sum("killed").alias("killed")
    )
    rows = store.read("sessions").join(kills, ["id", "capture_date"], "left")
    zero = F.lit(0).cast("bigint")
    return rows.select("id", "spawn", "loot_h", F.coalesce("creatures", zero).alias("creatures"), F.coalesce("killed", zero).alias("killed"), _day("capture_date"))


@query
def capture_build(d):
    """Listing and detail pages to sessions, members and kills, appended to a capture store and read from it.

    Three listings with their own parameters; a session that several found carries the last one's.
    """
    key = F.col("o_orderkey")
    link = F.concat(F.lit('<tr data-row-click-url-value="/hunt_sessions/'), key, F.lit('">'))
    by_run = F.array(*[F.when(key % m == 0, r) for r, m in ((1, 2), (2, 3), (3, 5))])
    listings = (
        d.table("orders").select(F.explode(F.array_compact(by_run)).alias("run"), F.floor(key / 100).alias("page"), link.alias("link"))
        .groupBy("run", "page").agg(F.array_join(F.collect_list("link"), "\n").alias("html"))  # a hundred links a page at most
    )
    runs = d.spark.createDataFrame(
        [(1, 100, 201, "Solo", ""), (2, 50, 301, "Duo", ""), (3, 0, 0, "x3", "quara")],
        "run int, query_min bigint, query_max bigint, query_party string, query_search string",
    )
    details = d.session_pages().select("id", F.concat(F.lit("https://example.org/s/"), "id").alias("url"), "html")
    store = CaptureStore(d.spark, fresh_path(d.spark, "capture"), capture.TABLES)
    store.append("2026-01-01", capture.build_capture(listings, details, runs))
    members = store.read("members").groupBy(F.col("hunt_id").alias("id")).agg(F.count(F.lit(1)).alias("members"), F.sum("level").alias("levels"))
    kills = store.read("kills").groupBy(F.col("hunt_id").alias("id")).agg(F.count(F.lit(1)).alias("creatures"), F.sum("killed").alias("killed"))
    rows = store.read("sessions").join(members, "id", "left").join(kills, "id", "left")
    return rows.select(
        "id", "url", "spawn", "minutes", "party_size", "avg_lvl", "balance", "supplies_total", "query_min", "query_max", "query_search",
        F.coalesce("members", F.lit(0).cast("bigint")).alias("members"), "levels", "creatures", "killed",
    )


@query
def json_map_explode(d):
    """Entries of the JSON map documents in the event table."""
    rows = snapshots.explode_map_documents(d.table("events").select("event_id", "props"), F.col("props"), "bigint")
    return rows.select("event_id", "key", F.col("record").alias("value"))


@query
def jsonl_tolerant(d):
    """Records of JSON lines written from events; error events give a line cut off in the middle."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    cut = F.substr(line, F.lit(1), (F.length(line) / 2).cast("int"))
    lines = d.table("events").select(F.when(F.col("event_type") == "error", cut).otherwise(line).alias("value"))
    return documents.parse_json_lines(lines, F.col("value"), "event_id bigint, user_id bigint, event_type string")


@query
def manual_prices(d):
    """Notes from line items: returned lines count as ``buy_max``, the last by ship date wins."""
    notes = d.table("lineitem").select(
        F.concat(F.lit("item "), F.col("l_partkey").cast("string")).alias("item"),
        F.when(F.col("l_returnflag") == "R", "buy_max").otherwise("note").alias("side"),
        F.floor("l_extendedprice").cast("bigint").alias("price_gp"), "l_shipdate", "l_orderkey", "l_linenumber",
    )
    return demand.manual_prices(notes, ("l_shipdate", "l_orderkey", "l_linenumber", "price_gp"))


@query
def write_gold(d):
    """Bracket rankings written as a partitioned table and read back."""
    path = fresh_path(d.spark, "gold")
    columns = ["bracket", "id", "spawn", "xp_h", "rank"]
    best = sessions.top_sessions(sessions.with_brackets(d.exp_sessions()), "xp_h")
    sinks.write_gold(best, path, columns, partition="bracket", order=[F.col("rank")])
    return d.spark.read.parquet(path).select(*columns)


@query
def ladder_long(d):
    """Ladder of kept offers written as a long table and read back."""
    path = fresh_path(d.spark, "ladder")
    judged = prices.judged_levels(d.offers(), d.averages(), d.rules())
    sinks.write_ladder(prices.offer_ladder(judged), path)
    return d.spark.read.parquet(path).select("item_id", "side", "price", "units", "offers")


@query
def history_daily(d):
    """Day's last price snapshot per item, from line items as a price history."""
    history = d.table("lineitem").select(
        F.col("l_partkey").alias("item_id"),
        (F.unix_date(F.to_date("l_shipdate")).cast("double") * 86400 + F.col("l_orderkey") % 80000).alias("time"),
        F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice").cast("bigint")).alias("day_average_buy"),
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice").cast("bigint") + 10).alias("day_average_sell"),
        F.col("l_quantity").cast("bigint").alias("buy_offer"), (F.col("l_quantity") + 1).cast("bigint").alias("sell_offer"),
    )
    return prices.history_daily(history).select("item_id", _day("date"), "buy", "sell")


@query
def build_info(d):
    days, n_days = save_counted(d.event_days(), "event-days")
    flagged = sessions.flag_events(sessions.recent(d.sessions(), d.as_of, EXP_DAYS), days)
    prices_table, n_prices = d.counted_prices
    written = {
        "tagged_items": demand.item_tags(d.imbuing(), d.delivery(), prices_table),
        "spawn_items": spawn_items(d), "manual_prices": manual_prices(d),
    }
    sizes = {name: save_counted(df, name)[1] for name, df in written.items()}
    return sessions.run_metrics(flagged, d.as_of, EXP_DAYS, PROFIT_DAYS, price_items=n_prices, events_days=n_days, **sizes)


# ---- scalar parsing -----------------------------------------------------------------------------


@query
def parse_session_date_(d):
    return d.date_texts().select(
        "o_orderkey", F.date_format(parse_session_date(F.col("text")), "yyyy-MM-dd").alias("day")
    )


@query
def parse_duration_(d):
    return d.duration_texts().select("o_orderkey", parse_duration(F.col("text")).cast("bigint").alias("minutes"))


@query
def lenient_int_(d):
    return d.number_texts().select("o_orderkey", lenient_int(F.col("text")).alias("n"))


@query
def first_number_(d):
    return d.number_texts().select("o_orderkey", first_number(F.col("text")).alias("n"))


@query
def parse_money_range_(d):
    r = parse_money_range(F.col("text"))
    return d.money_texts().select("p_partkey", r["lo"].alias("lo"), r["hi"].alias("hi"))


@query
def canon_tokens_(d):
    return d.titles().select("page_id", F.array_join(canon_tokens(F.col("title")), "|").alias("tokens"))


@query
def norm_name_(d):
    return d.titles().select("page_id", norm_name(F.col("title")).alias("norm"))


@query
def epoch_text_(d):
    """Event times as epoch text and back."""
    seconds = F.when(F.col("event_type") == "error", "n/a").otherwise(
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("bigint").cast("string")
    )
    return d.table("events").select("event_id", epoch_text(seconds).alias("captured_at"))


@query
def name_resolve(d):
    wanted = d.creature_items().select(F.lower("item").alias("item")).distinct()
    dim = d.metadata().withColumn("key", F.lower("name"))
    return names.resolve_names(wanted, "item", dim, "key", ["id", "name"])


@query
def digits_only(d):
    return d.number_texts().select("o_orderkey", text_digits(F.col("text")).alias("digits"))


@query
def delivery_sheet(d):
    """The delivery list as a sheet names its columns; some rows blank."""
    sheet = d.delivery_items().select(
        F.when(F.length("item") % 4 != 0, F.concat(F.lit(" "), "item", F.lit(" "))).alias("Item"), F.col("creatures").alias("Drops from"),
        F.when(F.col("npc") != "Brand#2", F.col("npc")).alias("Buyer"), F.concat(F.lit("~"), "npc_price", F.lit(" gp")).alias("Price"), F.col("qty").alias("Quantity"),
    )
    return extract.delivery_sheet(sheet, "Item", "Drops from", "Buyer", "Price", "Quantity")


@query
def year_gate(d):
    """Claims and guide rows of the required year or later, per source and year."""
    guides = sessions.year_floor(d.guides(), year_of(F.col("source_date")), MIN_YEAR, keep_undated=False)
    claims = sessions.year_floor(d.claims(), year_of(F.col("date")), MIN_YEAR, keep_undated=False)
    return guides.select(F.lit("guide").alias("kind"), "spawn", F.col("source_date").alias("date")).unionByName(
        claims.select(F.lit("community").alias("kind"), "spawn", "date")
    )


@query
def event_days_from_text(d):
    days = event_days(F.col("text"), year_of(F.col("date_text")))
    return d.news().select("o_orderkey", F.explode(days).alias("date")).select("o_orderkey", _day("date"))


@query
def kills_per_hour(d):
    joined = d.kills().join(d.sessions().select(F.col("id").alias("hunt_id"), "minutes"), "hunt_id")
    return joined.select("hunt_id", "creature", per_hour(F.col("killed"), F.col("minutes")).alias("kills_per_h"))


@query
def session_loot(d):
    return extract.session_rows(d.session_pages()).select(
        "id", "balance", "supplies_known", "supplies_total", "loot_total", "loot_h"
    )


@query
def level_fallback(d):
    return extract.session_rows(d.session_pages()).select("id", "party_size", "avg_lvl")


@query
def party_label_size(d):
    """Party size meant by query labels, and the middle of the queried range."""
    return d.session_pages().select(
        "id", party_size_of(F.col("query_party")).cast("bigint").alias("size"),
        bracket_middle(F.col("query_min"), F.col("query_max")).alias("middle"),
    )


@query
def loot_rate(d):
    s = d.sessions()
    return s.select("id", loot_per_hour(F.col("loot_h"), F.col("balance_h"), F.col("minutes")).alias("rate"))


@query
def confidence_band_(d):
    spread = F.round(F.col("o_totalprice") / 200000, 2)
    return d.table("orders").select("o_orderkey", confidence_band(spread).alias("band"))


@query
def content_score_(d):
    return d.posts().select("id", content_score(F.col("selftext")).alias("substance"))


# ---- extraction ---------------------------------------------------------------------------------


@query
def page_links(d):
    return extract.page_links(d.table("pages"), r'href="([^"]+)"', alias="href")


@query
def page_fields(d):
    rows = extract.page_fields(d.session_pages())
    return rows.select(
        "id", "spawn", "date_text", "duration", *_long("minutes"), "xp_gain", "raw_xp_gain", "balance", "xp_h",
        "raw_xp_h", "balance_h",
    )


@query
def page_table_rows(d):
    return extract.member_rows(d.session_pages(), "id")


@query
def page_kill_rows(d):
    return extract.kill_rows(d.session_pages(), "id")


@query
def party_rollup(d):
    return extract.session_rows(d.session_pages()).select(
        "id", "party_size", "min_lvl", "max_lvl", "avg_lvl", "party_comp", "has_creature_stats"
    )


@query
def wiki_materials(d):
    return extract.wiki_materials(d.wiki_texts())


@query
def tabbed_rows(d):
    return extract.tabbed_rows(d.tab_pages())


# ---- filters ------------------------------------------------------------------------------------


@query
def recent_sessions(d):
    rows = sessions.recent(d.sessions(), d.as_of, 60)
    return rows.select("id", "spawn", _day("hunt_date"), F.datediff(d.as_of, "hunt_date").cast("bigint").alias("age"))


@query
def exclude_events(d):
    return d.profit_sessions().select("id", "spawn", _day("hunt_date"))


@query
def event_flags(d):
    return sessions.flag_events(sessions.recent(d.sessions(), d.as_of, 365), d.event_days()).select("id", "event_flag")


@query
def bracket_rankings(d):
    return sessions.top_sessions(sessions.with_brackets(d.profit_sessions(), overall=False), "loot_h").select(
        "bracket", "rank", "id", "spawn", "loot_h", *_long("avg_lvl")
    )


@query
def red_filter(d):
    joined = d.offers().join(prices.reference_prices(d.averages()), "item_id")
    unfair = F.count_if(prices.is_unfair())
    return joined.groupBy("item_id", "side").agg(F.count(F.lit(1)).alias("offers"), unfair.alias("unfair"))


@query
def keyword_filter(d):
    return events.event_news(d.news()).select("o_orderkey", "title")


@query
def ranking_view(d):
    best = sessions.top_sessions(sessions.with_brackets(d.exp_sessions()), "xp_h").filter("bracket = '100_200'")
    return sessions.ranking_view(best, "xp_h", party="2", search="household").select("rank", "id", "spawn", "xp_h")


@query
def demand_view(d):
    tags = demand.item_tags(d.imbuing(), d.delivery(), d.saved_prices)
    return demand.demand_view(tags, "delivery", "fair", "e").select("item", "fair", "delivery_npcs", "npc_price")


@query
def guide_fallback(d):
    agreed = con.consensus(_compared(d)[0])
    return con.guide_fallback(agreed, d.guides(), ["50_100", "100_200", "200_300", "300_up"])


# ---- joins --------------------------------------------------------------------------------------


@query
def kills_enriched(d):
    return kills.kills_enriched(d.kills(d.exp_sessions()), d.exp_sessions()).select(
        "hunt_id", "spawn", _day("hunt_date"), "minutes", "creature", "killed", "kills_per_h", "xp_h", "loot_h",
        "balance_h", "url",
    )


@query
def bracket_kills(d):
    split = sessions.with_brackets(d.profit_sessions(), overall=False).filter("bracket = '100_200'")
    return kills.bracket_kills(d.kills(split), split)


@query
def pending_keys(d):
    """Creatures killed lately that the older captures do not know."""
    names_ = latest.distinct_names(d.kills(d.profit_sessions()), "creature")
    known = d.creature_items().filter(F.col("item").startswith("SMALL")).select("creature")
    return latest.pending_keys(names_, known, "creature")


@query
def retry_cooldown(d):
    """Pending creatures without those that failed in the last seven days."""
    failures = (
        d.table("lineitem").filter("l_returnflag = 'R'")
        .join(d.table("part").select("p_partkey", d.creature_of().alias("creature")), F.col("l_partkey") == F.col("p_partkey"))
        .select("creature", F.to_date("l_shipdate").alias("failed_on"))
    )
    pending = pending_keys(d)
    return latest.cooled_down(pending, failures, "creature", d.as_of)


@query
def lookup_cache(d):
    """Two days of creature lookups, half of the creatures and then all; what is held and what failed when."""
    cache = LookupCache(d.spark, fresh_path(d.spark, "lookup-cache"), "creature")
    wanted = save(latest.distinct_names(d.kills(), "creature"), "wanted-creatures")
    source = d.creature_items().filter(~F.col("item").startswith("SMALL"))
    source = source.groupBy("creature").agg(F.count_distinct("item").alias("n_items"))
    first = F.md5("creature") < "8"
    for number, (asked, days) in enumerate([(wanted.filter(first), 10), (wanted, 5)], 1):
        day = F.date_sub(d.as_of, days)
        tried = save(cache.pending(asked, day), "tried-creatures")
        cache.record(number, tried, save(source.join(tried, "creature", "left_semi"), "answers"), day)
    held = cache.answers().select("creature", "n_items", F.lit("held").alias("state"), F.col("answered_on").alias("noted_on"))
    failed = cache.failures().select(
        "creature", F.lit(None).cast("bigint").alias("n_items"), F.lit("failed").alias("state"), F.col("failed_on").alias("noted_on")
    )
    return held.unionByName(failed).select("creature", "n_items", "state", _day("noted_on"))


def _order_targets(d: Domain, daily: int | None) -> DataFrame:
    plural = F.when(F.col("p_partkey") % 2 == 0, "s").otherwise("")
    watch = d.table("part").filter("p_size = 1 and p_brand = 'Brand#2'").select(F.concat(d.item_name(), plural).alias("name"))
    wanted = targets.wanted_items(watch, d.creature_items(), d.metadata())
    volumes = demand.monthly_volume(latest.last_captures(d.volumes(), 2))
    return targets.capture_targets(wanted, volumes, d.rules(), 300, daily)


@query
def order_targets(d):
    """Items today's order-book capture has still to fetch."""
    return _order_targets(d, 40)


@query
def order_targets_full(d):
    """Items the weekly order-book capture has still to fetch."""
    return _order_targets(d, None)


@query
def item_tags(d):
    return demand.item_tags(d.imbuing(), d.delivery(), d.saved_prices)


@query
def item_labels(d):
    """Every label of every listed item."""
    return demand.item_labels(d.imbuing(), d.delivery())


@query
def similar_names(d):
    keys = names.name_keys(d.names())
    return names.similar_keys(keys)


# ---- aggregations -------------------------------------------------------------------------------


@query
def spawn_stats(d):
    return sessions.spawn_stats(d.profit_sessions()).select(
        "spawn", "n_hunts", "median_xp_h", "max_xp_h", "median_profit_h", "max_profit_h", *_long("n_full_loot"),
        *_long("min_lvl_seen", "max_lvl_seen"), "sample_url",
    )


@query
def spawn_stats_brackets(d):
    return d.bracket_stats().select(
        "bracket", "spawn", "n_hunts", "median_xp_h", "max_xp_h", "median_profit_h", "max_profit_h",
        *_long("n_full_loot", "min_lvl_seen", "max_lvl_seen"), "sample_url",
    )


@query
def missing_values(d):
    return d.value_gaps()


@query
def spawn_items(d):
    return kills.spawn_items(d.sessions().select("id", "spawn"), d.kills(), d.creature_items(), d.saved_prices, d.metadata())


@query
def price_stats(d):
    return d.prices()


@query
def trimmed_vwap(d):
    return prices.trimmed_vwap(_ladder(d))


@query
def shelf_price(d):
    return prices.shelf_price(_ladder(d))


def _ladder(d: Domain) -> DataFrame:
    return save(prices.kept_ladder(prices.judged_levels(d.offers(), d.averages(), d.rules())), "ladder")


@query
def weighted_quantile(d):
    sells = _ladder(d).filter("side = 'sell'")
    return order_stats.weighted_quantile(sells, ["item_id"], F.col("price"), F.col("units"), 25, "p25")


@query
def depth_band(d):
    ladder = _ladder(d)
    return prices.depth_band(ladder, prices.trimmed_vwap(ladder))


@query
def weighted_median(d):
    """Median unit price per brand and ship year, weighted by quantity."""
    rows = (
        d.table("lineitem").join(d.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "p_brand", F.year("l_shipdate").cast("bigint").alias("y"),
            F.floor("l_extendedprice").cast("bigint").alias("v"), F.col("l_quantity").cast("bigint").alias("w"),
        )
    )
    return order_stats.weighted_median(rows, ["p_brand", "y"], F.col("v"), F.col("w"), "wmedian")


@query
def value_per_kill(d):
    return d.values


@query
def spawn_profit(d):
    return d.bracket_profit()


@query
def spawn_loot(d):
    return kills.spawn_loot(
        d.calibration(), d.calibration_kills, d.creature_items(), d.values, d.saved_prices, demand.demand_marks(d.imbuing(), d.delivery())
    )


def _compared(d: Domain) -> tuple[DataFrame, DataFrame]:
    rows = con.evidence(
        d.bracket_profit(), d.bracket_stats(), d.guides(), d.claims(), d.as_of, MIN_YEAR, ["50_100", "100_200", "200_300"]
    )
    return con.profit_compare(rows)


@query
def profit_compare(d):
    return _compared(d)[0].select("bracket", "spawn", "norm", "kind", "source", "lo", "hi", "n", "date", "url", "cluster")


@query
def cluster_members(d):
    return _compared(d)[1]


@query
def profit_consensus(d):
    return con.consensus(_compared(d)[0])


@query
def profit_view(d):
    compared, members = _compared(d)
    agreed = save(con.consensus(compared), "consensus")
    found = con.profit_view(agreed, members, "100_200", "nation").withColumn("search", F.lit("nation"))
    return found.unionByName(con.profit_view(agreed, members, "50_100").withColumn("search", F.lit("")))


@query
def mode_name(d):
    return names.most_frequent(d.kills().join(d.sessions().select(F.col("id").alias("hunt_id"), "spawn"), "hunt_id"), ["spawn"], "creature", "creature")


@query
def book_merge(d):
    """Item books by ship month: of the last seven months the newest book per item."""
    books = (
        d.offers().groupBy("item_id", F.date_trunc("month", "captured").cast("date").alias("capture_date"))
        .agg(F.count(F.lit(1)).alias("offers"), F.sum("units").alias("units"))
    )
    return prices.book_merge(books).select("item_id", _day("capture_date"), "offers", "units")


@query
def item_volume(d):
    return demand.monthly_volume(latest.last_captures(d.volumes(), 2))


@query
def distinct_names(d):
    return latest.distinct_names(d.creature_items(), "item", lower=True)


@query
def name_clusters(d):
    return names.cluster_names(d.names())


@query
def name_clusters_grown(d):
    """Clusters grown in three runs, each with a third of the names; only what is new is compared."""
    listed, path = save(d.names(), "listed-names"), fresh_path(d.spark, "grown-clusters")
    third = F.pmod(F.xxhash64("name"), F.lit(3))
    for number in range(3):
        names.grow_clusters(listed.filter(third == number), path, number + 1)
    return names.grown_clusters(listed, path)


# ---- windows, top-k -----------------------------------------------------------------------------


@query
def topk_per_group(d):
    """The four dearest items of each creature."""
    return kills.top_loot(d.creature_items(), d.saved_prices, demand.demand_marks(d.imbuing(), d.delivery()))


@query
def kill_share(d):
    return kills.kill_share(d.kills()).withColumn("share", F.round("share", 6))


@query
def pct_of_max(d):
    top = topk.top_n(d.exp_sessions().select("id", "spawn", "xp_h"), [F.desc("xp_h"), F.col("id")], 10, "position")
    return topk.percent_of_max(top, "xp_h")


@query
def top_sessions(d):
    xp = sessions.top_sessions(sessions.with_brackets(d.exp_sessions()), "xp_h").withColumn("metric", F.lit("xp_h"))
    loot = sessions.top_sessions(sessions.with_brackets(d.profit_sessions()), "loot_h").withColumn("metric", F.lit("loot_h"))
    return xp.unionByName(loot).select("metric", "bracket", "rank", "id", "xp_h", "loot_h")


@query
def volume_topn(d):
    volumes = demand.monthly_volume(latest.last_captures(d.volumes(), 2))
    held = d.rules().select("item_id")
    return demand.refresh_by_volume(volumes, held, 150, 40).select("item_id", "volume", "position")


def _wanted(d: Domain) -> DataFrame:
    """Items wanted for capture: size-1 parts are watched, the others come through the loot lists."""
    return d.table("part").select(
        F.col("p_partkey").alias("item_id"), F.lower(d.item_name()).alias("name"),
        F.when((F.col("p_size") == 1) & (F.col("p_brand") == "Brand#2"), 1).otherwise(0).cast("bigint").alias("watched"),
    )


@query
def quota_full(d):
    return demand.quota_full(_wanted(d), 300)


@query
def quota_daily(d):
    volumes = demand.monthly_volume(latest.last_captures(d.volumes(), 2))
    return demand.quota_daily(demand.quota_full(_wanted(d), 300), volumes, 40)


@query
def quota_select(d):
    return demand.quota_select(_wanted(d), demand.monthly_volume(latest.last_captures(d.volumes(), 2)), 300)


@query
def discussed_posts(d):
    return content.discussed_posts(d.posts()).select("position", "id", "heat")


@query
def content_rank(d):
    return content.content_rank(d.posts(), d.comments())


@query
def kpi_best(d):
    return sessions.kpi_best(d.bracket_stats().filter("bracket = '100_200'"))


@query
def event_days_known(d):
    """Event days of the last four news captures, with days set by hand."""
    news = d.news().withColumn("capture_date", F.trunc(F.to_date("date_text"), "year"))
    captured = news.select("capture_date", F.explode(event_days(F.col("text"), year_of(F.col("date_text")))).alias("date"))
    return events.known_event_days(captured, ["2026-09-05", "2026-09-06"]).select(_day("date"))


QUERIES["event_days"] = QUERIES.pop("event_days_known")


@query
def days_from_news(d):
    return events.days_from_news(events.event_news(d.news())).select(_day("date"), "name")


# ---- incremental --------------------------------------------------------------------------------

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _in_batches(d: Domain, rows: DataFrame, ddl: str, run: Callable[[DataFrame], None]) -> None:
    """Deliver rows part by part to a stream that is started anew for each: a part's files, however many, are a batch."""
    path = fresh_path(d.spark, "event-files")
    for k in range(3):
        rows.filter(F.col("part") == k).drop("part").write.parquet(f"{path}/part={k}")
        run(d.spark.readStream.schema(ddl).parquet(f"{path}/part=*"))


def _numbered_events(d: Domain) -> DataFrame:
    """The events in three parts in the order of their numbers; events without a number come first."""
    rows = d.table("events")
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    step = ((high or 0) - (low or 0)) // 3 + 1
    return rows.withColumn("part", F.coalesce(F.floor((F.col("event_id") - F.lit(low)) / step), F.lit(0)).cast("int"))


@query
def stream_upsert(d):
    """Newest event per user, folded into a bucketed store by a stream of three batches; a bucket's second delta makes a new base."""
    path, checkpoint = fresh_path(d.spark, "upsert"), fresh_path(d.spark, "upsert-log")
    keys, version = ["user_id"], ["ts", "event_id"]
    _in_batches(d, _numbered_events(d), _EVENTS, lambda s: incremental.upsert_latest(s, path, checkpoint, keys, version, every=2, buckets=8))
    return incremental.read_latest(d.spark, path, keys, version).select("user_id", "event_id", "event_type", "value")


@query
def stream_append(d):
    """First event per user by batch, appended by a stream of three batches."""
    path, checkpoint = fresh_path(d.spark, "append"), fresh_path(d.spark, "append-log")
    _in_batches(d, _numbered_events(d), _EVENTS, lambda s: incremental.append_unseen(s, path, checkpoint, "user_id", ["ts", "event_id"]))
    return d.spark.read.parquet(path).select("user_id", "event_id", "event_type")


@query
def stream_dedup(d):
    """Events that are delivered again with the next batch count once, by the state of a stream that is restarted twice.

    Parts are thirds of the events' time; what falls into the last sixth of a part comes again with the next one. Error
    events carry no key, so every delivery of them stays.
    """
    second = F.expr("timestampdiff(second, timestamp_ntz'1970-01-01 00:00:00', ts)")
    rows = d.table("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), second.alias("second"))
    low, high = rows.agg(F.min("second"), F.max("second")).first()
    third = ((high or 0) - (low or 0)) // 3 + 1
    since = F.col("second") - F.lit(low)
    rows = rows.withColumn("part", F.floor(since / third).cast("int"))
    again = rows.filter(F.pmod(since, F.lit(third)) >= third - third // 6).withColumn("part", F.col("part") + 1)
    key = F.when(F.col("event_type") != "error", F.col("event_id"))
    delivered = rows.unionByName(again).filter("part < 3").select("part", key.alias("key"), "event_id", "event_type", "ts")
    path, checkpoint = fresh_path(d.spark, "dedup"), fresh_path(d.spark, "dedup-log")
    ddl = "key bigint, event_id bigint, event_type string, ts timestamp"
    _in_batches(d, delivered, ddl, lambda s: incremental.append_deduplicated(s, path, checkpoint, "key", "ts", f"{third} seconds"))
    return d.spark.read.parquet(path).select("event_id", "event_type")


@query
def captures_fold(d):
    """The mapping that never expires: newest event per user over daily captures, folded in two runs.

    The second run opens only the captures that the first has not seen; a third finds none.
    """
    root, store = fresh_path(d.spark, "daily"), fresh_path(d.spark, "mapping")
    daily = latest.latest_by_key(_event_captures(d), ["user_id", "capture_date"], ["ts", "event_id"])
    daily = save(daily.select("user_id", "event_id", "event_type", "capture_date"), "daily-events")
    middle = daily.agg(F.expr("date_add(min(capture_date), int(datediff(max(capture_date), min(capture_date)) div 2))")).scalar()
    for due in (F.col("capture_date") <= middle, F.col("capture_date") > middle, F.lit(False)):
        daily.filter(due).write.mode("append").option("header", True).partitionBy("capture_date").csv(root)
        snapshots.fold_captures(d.spark, root, "part-*", "user_id bigint, event_id bigint, event_type string", store, ["user_id"])
    rows = keyed_store.read(d.spark, store, ["user_id"], ["capture_date"])
    return rows.select("user_id", "event_id", "event_type", _day("capture_date"))


@query
def append_new(d):
    """Users' first events of the second half that the first half did not bring."""
    rows = d.table("events")
    middle = rows.agg(F.expr("timestampadd(second, timestampdiff(second, min(ts), max(ts)) div 2, min(ts))")).scalar()
    store, incoming = rows.filter(F.col("ts") < middle), rows.filter(F.col("ts") >= middle)
    fresh = latest.append_new(store, incoming.withColumn("user_id", F.col("user_id") + F.when(F.col("event_type") == "error", 1000000).otherwise(0)), "user_id", ["ts", "event_id"])
    return fresh.select("user_id", "event_id", "event_type")


# Functions whose plain name belongs to the expression they show.
for _name in [n for n in QUERIES if n.endswith("_")]:
    QUERIES[_name.rstrip("_")] = QUERIES.pop(_name)


def bound_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries as the driver calls them: (spark, folder of the tables) -> DataFrame."""

    def bind(fn):
        return lambda spark, sf_dir: fn(Domain(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
