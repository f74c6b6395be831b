"""Domain views over the driver's tables: sessions, kills, order books, lists, texts and pages.

Every view reads its whole tables. ``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import DELIVERY_TABS
from ..operators.prices import price_stats
from ..operators.sessions import bracket_tags, exclude_events, recent, spawn_stats, with_bracket_sets, with_brackets
from ..operators.kills import calibration_sessions, missing_values, spawn_profit, value_per_kill
from ..operators.demand import delivery_rows
from ..session import save, save_counted

PROFIT_DAYS, EXP_DAYS, MIN_YEAR = 60, 365, 2026
TIERS = ("Basic", "Intricate", "Powerful")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(x: Column) -> Column:
    return x.cast("string")


def _grouped(x: Column) -> Column:
    """12345678 -> 12345,678: enough thousands grouping for a lenient reader."""
    return F.concat(_text(F.floor(x / 1000)), F.lit(","), F.lpad(_text(x % 1000), 3, "0"))


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def tasks(self, table: str, rows: int) -> int:
        """Partitions so that none gets more rows of a table than given. As a number, which adaptive execution does not merge:
        it goes by shuffled bytes, of which rows that grow wide behind the shuffle have few. Counts come from the files' footers."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1 + self.table(table).count() // rows)

    @cached_property
    def as_of(self) -> Column:
        """Newest order date: the run's date, never the wall clock. As a constant it can be pushed down."""
        return F.lit(self.table("orders").agg(F.max("o_orderdate").cast("date")).first()[0])

    # ---- sessions and kills -------------------------------------------------------------------

    def places(self) -> DataFrame:
        """Orders with the place name of their customer."""
        nation = self.table("nation").select("n_nationkey", "n_name")
        spawn = F.concat_ws(" ", "n_name", "c_mktsegment")
        customers = (
            self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", spawn.alias("spawn"))
        )
        return self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))

    def sessions(self) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        loot = F.col("o_totalprice").cast("bigint") - 20000
        return self.places().select(
            _text(key).alias("id"),
            F.concat(F.lit("https://example.org/s/"), _text(key)).alias("url"),
            "spawn",
            F.to_date("o_orderdate").alias("hunt_date"),
            (key % 90).alias("minutes"),
            (1 + key % 4).alias("party_size"),
            F.when(key % 97 == 0, 0).otherwise(50 + cust % 251).alias("avg_lvl"),
            (F.col("o_totalprice") * 10).cast("bigint").alias("xp_h"),
            loot.alias("loot_h"),
            (loot - 5000).alias("balance_h"),
            F.when(F.col("o_orderstatus") != "P", 1).otherwise(0).cast("bigint").alias("supplies_known"),
        )

    def event_days(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        return self.table("orders").filter(F.dayofmonth(day) <= 3).select(day.alias("date")).distinct()

    @cached_property
    def saved_sessions(self) -> DataFrame:
        return save(self.exp_sessions(), "sessions")

    @cached_property
    def saved_kills(self) -> DataFrame:
        return save(self.kills(), "kills")

    @cached_property
    def calibration_kills(self) -> DataFrame:
        return save(self.kills(self.calibration()), "calibration-kills")

    @cached_property
    def counted_prices(self) -> tuple[DataFrame, int]:
        return save_counted(self.prices(), "prices")

    @property
    def saved_prices(self) -> DataFrame:
        return self.counted_prices[0]

    def exp_sessions(self) -> DataFrame:
        return exclude_events(recent(self.sessions(), self.as_of, EXP_DAYS), self.event_days())

    def profit_sessions(self) -> DataFrame:
        return exclude_events(recent(self.sessions(), self.as_of, PROFIT_DAYS), self.event_days())

    def calibration(self) -> DataFrame:
        return calibration_sessions(self.saved_sessions, self.as_of)

    def creature_of(self) -> Column:
        return F.concat_ws(" ", "p_brand", "p_name")

    def kills(self, sessions: DataFrame | None = None) -> DataFrame:
        """Kills of all sessions, or of the given ones alone: the others go before anything is added up."""
        parts = self.table("part").select("p_partkey", self.creature_of().alias("creature"))
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        if sessions is not None:
            lines = lines.join(sessions.select(F.col("id").cast("bigint").alias("l_orderkey")), "l_orderkey", "left_semi")
            parts = parts.hint("merge")  # few lines are left: dealing them out is less than sending all parts everywhere
        # Dealt by session once: adding up per creature and windows over a session need nothing more. How many lines given
        # sessions leave is not known before, so then tasks go by what was shuffled.
        dealt = ["hunt_id"] if sessions is not None else [self.tasks("lineitem", 200_000), "hunt_id"]
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(_text(F.col("l_orderkey")).alias("hunt_id"), "creature", F.col("l_quantity").cast("bigint").alias("killed"))
            .repartition(*dealt)
            .groupBy("hunt_id", "creature")
            .agg(F.sum("killed").alias("killed"))
        )

    def session_captures(self) -> DataFrame:
        """Every session captured on three days, its numbers changing each time."""
        day = F.explode(F.array(*[F.lit(i) for i in range(3)]))
        return (
            self.sessions().select("id", "spawn", "loot_h", day.alias("k"))
            .withColumn("capture_date", F.date_add(F.lit("2026-01-01").cast("date"), F.col("k")))
            .withColumn("loot_h", F.col("loot_h") + F.col("k"))
            .drop("k")
        )

    @cached_property
    def values(self) -> DataFrame:
        return save(value_per_kill(self.calibration(), self.calibration_kills), "values")

    def bracket_profit(self) -> DataFrame:
        """Computed profit overall (120 days) and per bracket (60 days), in one pass."""
        fresh = F.col("hunt_date") >= F.date_sub(self.as_of, PROFIT_DAYS)
        return spawn_profit(with_bracket_sets(self.calibration(), when=fresh), self.calibration_kills, self.values)

    def value_gaps(self) -> DataFrame:
        """Creatures without a value, as if every second value were unknown."""
        fresh = F.col("hunt_date") >= F.date_sub(self.as_of, PROFIT_DAYS)
        known = self.values.filter(F.length("creature") % 2 == 0)
        return missing_values(with_bracket_sets(self.calibration(), when=fresh), self.calibration_kills, known)

    def bracket_stats(self) -> DataFrame:
        fresh = recent(self.saved_sessions, self.as_of, PROFIT_DAYS)
        return spawn_stats(with_brackets(fresh), ("bracket", "spawn"))

    # ---- items and prices ---------------------------------------------------------------------

    def item_name(self) -> Column:
        return F.concat_ws(" ", "p_type", F.split("p_name", " ")[1])

    def creature_items(self) -> DataFrame:
        plural = F.when(F.col("p_partkey") % 3 == 0, "s").otherwise("")
        return self.table("part").select(
            self.creature_of().alias("creature"), F.concat(self.item_name(), plural).alias("item")
        ).distinct()

    def metadata(self) -> DataFrame:
        """Every item id with its name: many ids share a name, some in another case."""
        name = F.when(F.col("p_partkey") % 5 == 0, F.lower(self.item_name())).otherwise(self.item_name())
        return self.table("part").select(name.alias("name"), F.col("p_partkey").alias("id"))

    def offers(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("item_id"),
            F.when(F.col("l_returnflag") == "N", "sell").otherwise("buy").alias("side"),
            F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint").alias("price"),
            F.col("l_quantity").cast("bigint").alias("units"),
            (F.col("l_suppkey") % 10 == 0).alias("anonymous"),
            F.col("l_shipdate").alias("captured"),
            "l_linestatus",
        )

    def averages(self) -> DataFrame:
        """Average prices per item: the day's from closed lines (0 for some items), the month's from all."""
        sell = F.col("side") == "sell"
        closed = F.col("l_linestatus") == "F"

        def mean(rows: Column) -> Column:
            total, n = F.sum(F.when(rows, F.col("price"))), F.count_if(rows)
            return F.coalesce(F.when(n > 0, F.floor(total / n)), F.lit(0)).cast("bigint")

        none = F.col("item_id") % 7 == 0
        return (
            self.offers().groupBy("item_id")
            .agg(
                mean(sell & closed).alias("ds"), mean(~sell & closed).alias("db"),
                mean(sell).alias("month_average_sell"), mean(~sell).alias("month_average_buy"),
            )
            .withColumn("day_average_sell", F.when(none, 0).otherwise(F.col("ds")))
            .withColumn("day_average_buy", F.when(none, 0).otherwise(F.col("db")))
            .drop("ds", "db")
        )

    def rules(self) -> DataFrame:
        """Sell cap for items of size 1, no anonymous offers for items of size 2."""
        return self.table("part").filter("p_size <= 2").select(
            F.col("p_partkey").alias("item_id"),
            (F.col("p_size") == 1).alias("has_cap"), F.lit(2500).cast("bigint").alias("max_sell_cap"),
            (F.col("p_size") == 2).alias("has_anon"), F.lit(True).alias("exclude_anonymous"),
        )

    def prices(self) -> DataFrame:
        return price_stats(self.offers(), self.averages(), self.rules(), self.metadata())

    def volumes(self) -> DataFrame:
        """Monthly sold and bought units per item and capture year."""
        sold = F.col("l_returnflag") == "N"
        units = F.col("l_quantity").cast("bigint")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("item_id"), F.date_trunc("year", "l_shipdate").cast("date").alias("capture_date"))
            .agg(F.sum(F.when(sold, units)).alias("month_sold"), F.sum(F.when(~sold, units)).alias("month_bought"))
        )

    # ---- demand lists -------------------------------------------------------------------------

    def imbuing(self) -> DataFrame:
        tier = F.col("p_size") % 3
        return self.table("part").filter("p_size <= 30").select(
            F.lower(self.item_name()).alias("item"), _pick(TIERS, tier).alias("tier"),
            F.col("p_brand").alias("imbuement"), (tier * 10 + 5).cast("bigint").alias("qty"),
        )

    def delivery_npc(self) -> DataFrame:
        return self.table("part").filter("p_size >= 21").select(
            self.item_name().alias("item"), _pick(DELIVERY_TABS, F.col("p_partkey") % len(DELIVERY_TABS)).alias("npc"),
            _text(F.col("p_retailprice").cast("bigint")).alias("npc_price"),
            _pick(("Low", "Mid", "High"), F.col("p_size") % 3).alias("market_band"),
        )

    def delivery_items(self) -> DataFrame:
        return self.table("part").filter("p_size >= 26").select(
            F.concat(self.item_name(), F.lit(" crate")).alias("item"), self.creature_of().alias("creatures"),
            F.col("p_brand").alias("npc"),
            F.when(F.col("p_size") % 5 == 0, "ask").otherwise(_text(F.col("p_size") * 100)).alias("npc_price"),
            F.lit("10-20").alias("qty"),
        )

    def delivery(self) -> DataFrame:
        return delivery_rows(self.delivery_npc(), self.delivery_items())

    # ---- texts --------------------------------------------------------------------------------

    def titles(self) -> DataFrame:
        """Page titles, whole."""
        return self.table("pages").select(
            "page_id", "url", F.trim(F.regexp_extract("html", "<h1[^>]*>([^<]*)", 1)).alias("title")
        )

    def names(self) -> DataFrame:
        """Page titles and full part names: few words in many mixtures, so some words are very common."""
        parts = self.table("part").select(F.concat_ws(" ", "p_type", "p_name").alias("name"))
        return self.titles().select(F.col("title").alias("name")).unionByName(parts)

    def date_texts(self) -> DataFrame:
        """Order dates as text; every 11th is broken."""
        good = F.date_format("o_orderdate", "MMM dd, yyyy HH:mm")
        bad = F.concat(F.lit("soon, "), _text(F.col("o_orderkey")))
        return self.table("orders").select(
            "o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, bad).otherwise(good).alias("text")
        )

    def duration_texts(self) -> DataFrame:
        m = F.col("o_orderkey") % 4000
        clock = F.format_string("%02d:%02dh", F.floor((m % 1440) / 60), m % 60)
        text = F.when(m >= 1440, F.concat(_text(F.floor(m / 1440)), F.lit("d "), clock)).otherwise(clock)
        return self.table("orders").select(
            "o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, "n/a").otherwise(text).alias("text")
        )

    def number_texts(self) -> DataFrame:
        key = F.col("o_orderkey")
        shape = key % 5
        text = (
            F.when(shape == 0, F.concat(F.lit("-"), _grouped(F.col("o_totalprice").cast("bigint")), F.lit(" gp")))
            .when(shape == 1, _text(F.col("o_totalprice").cast("decimal(12,2)")))
            .when(shape == 2, F.lit(""))
            .when(shape == 3, F.concat(F.lit("about "), _text(key)))
            .otherwise(F.concat(F.lit("-"), _text(key), F.lit(".75")))
        )
        return self.table("orders").select("o_orderkey", text.alias("text"))

    def money_texts(self) -> DataFrame:
        size, shape = F.col("p_size"), F.col("p_partkey") % 6
        text = (
            F.when(shape == 0, F.concat(_text(size), F.lit("k - "), _text(size * 2), F.lit("k")))
            .when(shape == 1, F.concat(_text(F.floor(size / 10)), F.lit(","), _text(size % 10), F.lit("KK")))
            .when(shape == 2, F.concat(_text(size), F.lit("000+")))
            .when(shape == 3, F.concat(_text(size * 2), F.lit("~"), _text(size), F.lit("k")))
            .when(shape == 4, F.lit("—"))
            .otherwise(F.concat(F.lit("1."), _text(size), F.lit(".5")))
        )
        return self.table("part").select("p_partkey", text.alias("text"))

    def news(self) -> DataFrame:
        """News with event ranges: plain, over a month's end, reversed, and single days."""
        date, shape = F.col("o_orderdate"), F.col("o_orderkey") % 5
        first = F.date_format(date, "MMMM d")
        later = F.date_add(date.cast("date"), 3)
        text = (
            F.when(shape == 0, F.concat(F.lit("It runs between the server saves of "), first, F.lit(" and "), F.date_format(later, "MMMM d"), F.lit(".")))
            .when(shape == 1, F.concat(F.lit("between the server saves of "), first, F.lit(" and "), _text(F.dayofmonth(date) + 2)))
            .when(shape == 2, F.concat(F.lit("between the server saves of "), F.date_format(later, "MMMM d"), F.lit(" and "), first))
            .when(shape == 3, F.concat(F.lit("Starts on "), first, F.lit(" at noon.")))
            .otherwise(F.lit("No date yet."))
        )
        title = F.when(F.col("o_orderpriority") == "1-URGENT", "Double XP and rapid respawn").otherwise(
            F.concat(F.lit("News about "), F.lower("o_orderpriority"))
        )
        return self.table("orders").select(
            "o_orderkey", title.alias("title"), text.alias("text"), F.date_format(date, "yyyy-MM-dd").alias("date_text")
        )

    def posts(self) -> DataFrame:
        rate = F.concat(F.lit("\nmade "), _text(F.col("doc_id")), F.lit("k/h at level 120 ek"))
        body = F.when(F.col("doc_id") % 9 == 0, F.concat(F.col("text"), rate)).otherwise(F.col("text"))
        return self.table("documents").select(
            F.col("doc_id").alias("id"), F.col("source").alias("title"), body.alias("selftext"),
            (F.col("n_chars") % 100).alias("score"), (F.col("doc_id") % 40).alias("num_comments"),
            F.concat(F.lit("https://example.org/post/"), _text(F.col("doc_id"))).alias("url"),
        )

    def comments(self) -> DataFrame:
        return self.table("conversations").select(
            F.concat_ws("/", _text(F.col("conv_id")), _text(F.col("turn"))).alias("id"),
            (F.col("conv_id") % 30).alias("score"), F.col("text").alias("body"),
        )

    # ---- evidence -----------------------------------------------------------------------------

    def guides(self) -> DataFrame:
        key, nat = F.col("s_suppkey"), F.col("s_nationkey")
        segment = _pick(SEGMENTS, key % 5)
        place = F.concat(F.lit("Nation_"), _text(nat))
        spawn = F.when(key % 2 == 0, F.concat(F.lower(segment), F.lit(" "), place, F.lit(" (team)"))).otherwise(
            F.concat(place, F.lit(" "), segment, F.lit("s [solo]"))
        )
        amount = (F.col("s_acctbal") * 10).cast("bigint")
        return self.table("supplier").select(
            spawn.alias("spawn"), F.when(key % 11 == 0, "300-up").otherwise(_pick(bracket_tags(), key % 3)).alias("bracket"),
            _text(amount * 2).alias("exp_lo"), F.when(key % 3 == 0, "").otherwise(_text(amount * 3)).alias("exp_hi"),
            F.when(key % 4 == 0, "").otherwise(_text(amount)).alias("profit_lo"),
            F.when(key % 7 == 0, "n/a").otherwise(_text(amount + 50000)).alias("profit_hi"),
            F.concat(F.lit("guide "), _text(nat % 4)).alias("source"),
            F.when(nat % 5 == 0, "2025-11").otherwise("2026-03").alias("source_date"),
        )

    def claims(self) -> DataFrame:
        n = F.col("page_id")
        return self.titles().select(
            F.col("title").alias("spawn"), "url",
            F.when(n % 6 == 0, "2025").otherwise("2026-02").alias("date"),
            F.when(n % 5 == 0, F.concat(_text(n), F.lit("k-"), _text(n * 2), F.lit("k"))).when(n % 5 == 1, "?")
            .otherwise(F.concat(_text(n + 1), F.lit("00"))).alias("profit_h"),
        )

    # ---- pages built from rows, to be read back -------------------------------------------------

    def session_pages(self) -> DataFrame:
        """A detail page per order: labelled fields, party table or name list, kill table."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        minutes = key % 90

        def field(label: str, value: Column) -> Column:
            return F.concat(F.lit(f'<p class="l">{label}</p>\n<p class="v"><b>'), value, F.lit("</b></p>"))

        size, total = 1 + key % 4, F.col("o_totalprice").cast("bigint")

        def person(s: Column) -> Column:
            voc = _pick(("ED", "EK", "RP", "MS", "EM"), (key + s) % 5)
            return F.concat(F.lit("Pl &amp; "), _text(s), F.lit(" ("), voc, F.lit(" "), _text(50 + (cust + s * 7) % 251), F.lit(")"))

        def full_row(s: Column) -> Column:
            cells = [
                _text(s), person(s), F.lit("1,000"), F.lit("500"),
                F.concat(F.lit("-"), _text(s * 100 + key % 50)), _grouped(total),
            ]
            return F.concat(F.lit("<tr class=r>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))

        slots = F.sequence(F.lit(1), size.cast("int"))
        table = F.concat(
            F.lit("<h3>Party Members</h3><table><tbody>"),
            F.array_join(F.transform(slots, full_row), ""), F.lit("</tbody></table>"),
        )
        listed = F.array_join(
            F.transform(slots, lambda s: F.concat(F.lit("<td> "), F.replace(person(s), F.lit("&amp; "), F.lit("")), F.lit(" </td>"))), ""
        )
        party = (
            F.when(F.col("o_orderstatus") == "F", table).when(F.col("o_orderstatus") == "O", listed).otherwise("")
        )
        kill = F.array_join(
            F.transform(
                slots,
                lambda s: F.concat(
                    F.lit('<tr><td><img alt="Beast '), _text(s), F.lit(' &amp; kin" src="x"/> </td><td class=n> '),
                    _grouped(1000 * s + key % 1000), F.lit(" </td></tr>"),
                ),
            ),
            "",
        )
        html = F.concat(
            F.lit('<html><img alt="logo" src="l"/><td>9</td><h1 class="text-2xl">\n '), F.col("spawn"), F.lit(" &amp; co</h1><span>"),
            F.date_format("o_orderdate", "MMM dd, yyyy HH:mm"), F.lit("</span>"),
            field("Session Duration", F.format_string("%02d:%02dh", F.floor(minutes / 60), minutes % 60)),
            field("XP Gain", _grouped(total * 3)), field("Raw XP Gain", _grouped(total * 2)),
            field("Balance", F.concat(F.lit("-"), _grouped(total))),
            field("XP/h", _grouped(total * 10)), field("Raw XP/h", _grouped(total * 5)), field("Balance/h", _grouped(total)),
            party, F.lit("<h3>Monster Killed</h3><table>"), kill,
            F.lit('</table><table><img alt="other" src="y"/> </td><td>7</td></table></html>'),
        )
        # A page is far wider than the row it comes from, so rows are spread before pages are made.
        return self.places().repartition(self.tasks("orders", 20_000), "o_orderkey").select(
            _text(key).alias("id"), html.alias("html"), F.lit(100).cast("bigint").alias("query_min"),
            F.lit(201).cast("bigint").alias("query_max"), _pick(("Solo", "Duo", "x3", "?"), key % 4).alias("query_party"),
        )

    def wiki_texts(self) -> DataFrame:
        row = F.concat(
            F.lit("{|\n| [["), _pick(TIERS, F.col("p_size") % 3), F.lit(" "), F.col("p_brand"), F.lit("|x]] note\n| '''3%'''\n| "),
            _text(F.col("p_size")), F.lit(" [["), F.col("p_name"), F.lit("]]s, "), _text(F.col("p_size") + 5),
            F.lit(" [["), F.col("p_type"), F.lit("|shown]]\n|}"),
        )
        return self.table("part").select("p_partkey", row.alias("text"))

    def tab_pages(self) -> DataFrame:
        """Delivery pages: two tabs, three rows, one of them unreadable."""
        tabs = _pick(DELIVERY_TABS, F.col("p_partkey") % 9), _pick(DELIVERY_TABS, (F.col("p_partkey") + 4) % 9)

        def line(name: Column, price: Column, band: Column) -> Column:
            return F.concat(
                F.lit('<tr><td><a href="#">'), name, F.lit("</a></td> <td>"), price, F.lit('</td>\n<td class=c><b>'), band, F.lit("</b></td></tr>")
            )

        price = F.concat(_text(F.col("p_size")), F.lit(" "), F.lpad(_text(F.col("p_partkey") % 1000), 3, "0"))
        html = F.concat(
            F.lit("<body>"), line(F.lit("before"), F.lit("1"), F.lit("Low")),
            F.lit('<div id="'), tabs[0], F.lit('">'), line(F.col("p_name"), price, F.lit("Very High")),
            line(F.lit("unpriced"), F.lit("-"), F.lit("Low")),
            F.lit('</div><div id="'), tabs[1], F.lit('">'), line(F.col("p_type"), price, F.lit("Low")), F.lit("</div>"),
        )
        return self.table("part").select("p_partkey", html.alias("html"))
