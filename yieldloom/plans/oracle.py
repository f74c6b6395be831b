"""The registered queries in SQL (DuckDB dialect), over the same tables.

``VIEWS`` restates the views of ``domain.py``; a query names the views it needs and gets them, with what
they need in turn, as a WITH clause.
"""

from __future__ import annotations

from ..functions.content import LEVEL_MENTION, MONEY_RATE, PLACE_WORDS
from ..functions.names import STOPWORDS
from ..operators.extract import DELIVERY_TABS

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}
ORACLE: dict[str, str] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (sql, needs)


def oracle(name: str, sql: str, *needs: str) -> None:
    ordered: list[str] = []

    def add(n: str) -> None:
        if n not in ordered:
            for m in VIEWS[n][1]:
                add(m)
            ordered.append(n)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n][0]})" for n in ordered)
    recursive = "RECURSIVE " if any("_reach" in n for n in ordered) else ""
    ORACLE[name] = (f"WITH {recursive}{ctes}\n" if ctes else "") + sql


def ratio(n: str, d: str, digits: int) -> str:
    """Quotient of whole numbers rounded half away from zero, by whole-number arithmetic."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    scaled = f"CAST((abs({n}) * {2 * 10**digits} + abs({d})) // (abs({d}) * 2) AS DOUBLE)"
    return f"CASE WHEN {d} <> 0 THEN {scaled} * sign({n}) * sign({d}) / {10**digits} END"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# ---- sessions and kills -------------------------------------------------------------------------

view("as_of", "SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders")
view(
    "places",
    """SELECT o.*, n_name || ' ' || c_mktsegment AS spawn FROM orders o
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
view(
    "sessions",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'https://example.org/s/' || o_orderkey AS url, spawn,
         CAST(o_orderdate AS DATE) AS hunt_date, o_orderkey % 90 AS minutes, 1 + o_orderkey % 4 AS party_size,
         CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 50 + o_custkey % 251 END AS avg_lvl,
         CAST(trunc(o_totalprice * 10) AS BIGINT) AS xp_h, CAST(trunc(o_totalprice) AS BIGINT) - 20000 AS loot_h,
         CAST(trunc(o_totalprice) AS BIGINT) - 25000 AS balance_h,
         CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS supplies_known
       FROM places""",
    "places",
)
view("event_days", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE day(o_orderdate) <= 3")
view(
    "fresh365",
    "SELECT s.* FROM sessions s, as_of WHERE hunt_date >= d - 365",
    "sessions", "as_of",
)
view("exp_sessions", "SELECT * FROM fresh365 WHERE hunt_date NOT IN (SELECT date FROM event_days)", "fresh365", "event_days")
view("profit_sessions", "SELECT s.* FROM exp_sessions s, as_of WHERE hunt_date >= d - 60", "exp_sessions", "as_of")
view(
    "calibration",
    "SELECT s.* FROM exp_sessions s, as_of WHERE hunt_date BETWEEN d - 120 AND d AND minutes >= 15",
    "exp_sessions", "as_of",
)
view("creature_parts", "SELECT p_partkey, p_brand || ' ' || p_name AS creature FROM part")
view(
    "kills",
    """SELECT CAST(l_orderkey AS VARCHAR) AS hunt_id, creature, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS killed
       FROM lineitem JOIN creature_parts ON l_partkey = p_partkey GROUP BY ALL""",
    "creature_parts",
)
view("brackets", "SELECT * FROM (VALUES ('50_100', 50, 100), ('100_200', 100, 200), ('200_300', 200, 300)) b(bracket, lo, hi)")
view(
    "exp_brackets",
    """SELECT bracket, s.* FROM exp_sessions s JOIN brackets ON avg_lvl <> 0 AND avg_lvl BETWEEN lo AND hi
       UNION ALL SELECT 'all', * FROM exp_sessions""",
    "exp_sessions", "brackets",
)
view(
    "profit_brackets",
    """SELECT bracket, s.* FROM profit_sessions s JOIN brackets ON avg_lvl <> 0 AND avg_lvl BETWEEN lo AND hi
       UNION ALL SELECT 'all', * FROM profit_sessions""",
    "profit_sessions", "brackets",
)
STATS = """SELECT {keys}, count(*) AS n_hunts, CAST(trunc(median(xp_h)) AS BIGINT) AS median_xp_h, max(xp_h) AS max_xp_h,
    CAST(trunc(median(loot_h)) AS BIGINT) AS median_profit_h, max(loot_h) AS max_profit_h,
    count(*) FILTER (supplies_known <> 0) AS n_full_loot, min(nullif(avg_lvl, 0)) AS min_lvl_seen,
    max(nullif(avg_lvl, 0)) AS max_lvl_seen, arg_min(url, row(-xp_h, id)) AS sample_url
  FROM {source} GROUP BY ALL"""
view("bracket_stats", STATS.format(keys="bracket, spawn", source="profit_brackets"), "profit_brackets")

view("captures_raw", "SELECT id, spawn, loot_h + k AS loot_h, DATE '2026-01-01' + CAST(k AS INTEGER) AS capture_date FROM sessions, range(3) r(k)", "sessions")

USERS = """SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS capture_date FROM events
  {where} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
oracle("snapshot_window", USERS.format(where="WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS c FROM events ORDER BY c DESC LIMIT 14)"))
oracle("snapshot_all_latest", USERS.format(where=""))
oracle(
    "snapshot_latest",
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS capture_date FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
oracle("latest_by_key", "SELECT id, spawn, loot_h + 2 AS loot_h, '2026-01-03' AS capture_date FROM sessions", "sessions")
oracle(
    "capture_merge",
    """SELECT id, spawn, loot_h, strftime(capture_date, '%Y-%m-%d') AS capture_date FROM captures_raw c
       WHERE (capture_date = DATE '2026-01-02' AND loot_h > 100000)
          OR (capture_date = DATE '2026-01-01' AND NOT EXISTS (
              SELECT 1 FROM captures_raw n WHERE n.id = c.id AND n.capture_date = DATE '2026-01-02' AND n.loot_h > 100000))""",
    "captures_raw",
)
oracle(
    "json_map_explode",
    """SELECT event_id, e.key AS key, CAST(e.value AS BIGINT) AS value FROM events, json_each(CAST(props AS JSON)) e""",
)
NOTE = """'", [{' || o_orderpriority || chr(92)"""
oracle(
    "json_map_records",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(floor(o_totalprice) AS BIGINT) AS total, {NOTE} AS note, o_orderstatus AS status,
         year(o_orderdate) || '-12-31' AS capture_date FROM orders""",
)
oracle(
    "json_array_records",
    f"""SELECT o_orderkey AS id, {NOTE} AS note, year(o_orderdate) || '-12-31' AS capture_date FROM orders
       WHERE year(o_orderdate) IN (SELECT DISTINCT year(o_orderdate) AS y FROM orders ORDER BY y DESC LIMIT 3)""",
)
oracle(
    "capture_append",
    """SELECT * FROM (WITH held AS (
         SELECT '2026-01-01' AS capture_date, id, spawn, loot_h, 0 AS more FROM sessions WHERE CAST(id AS BIGINT) % 3 = 0
         UNION ALL SELECT '2026-01-02', id, spawn, loot_h, 0 FROM sessions WHERE CAST(id AS BIGINT) % 2 = 0 AND CAST(id AS BIGINT) % 5 <> 0
         UNION ALL SELECT '2026-01-02', id, spawn, loot_h + 7, 7 FROM sessions WHERE CAST(id AS BIGINT) % 5 = 0)
       SELECT h.id, spawn, loot_h, count(creature) AS creatures, CAST(coalesce(sum(killed + more), 0) AS BIGINT) AS killed, capture_date
       FROM held h LEFT JOIN kills k ON k.hunt_id = h.id AND (more = 0 OR length(creature) % 2 = 0) GROUP BY ALL)""",
    "sessions", "kills",
)
oracle("jsonl_tolerant", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
oracle(
    "manual_prices",
    """SELECT 'item ' || l_partkey AS item,
         arg_max(CAST(floor(l_extendedprice) AS BIGINT), row(l_shipdate, l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT))) AS price_gp
       FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""",
)
RANKED = """SELECT *, row_number() OVER (PARTITION BY bracket ORDER BY {m} DESC, id) AS rank FROM {source}
  QUALIFY rank <= 50"""
view("exp_ranked", RANKED.format(m="xp_h", source="exp_brackets"), "exp_brackets")
view("profit_ranked", RANKED.format(m="loot_h", source="profit_brackets"), "profit_brackets")
oracle("write_gold", "SELECT bracket, id, spawn, xp_h, rank FROM exp_ranked", "exp_ranked")
oracle(
    "history_daily",
    """SELECT item_id, date, arg_max(buy, row(time, coalesce(buy, -1), coalesce(sell, -1))) AS buy,
         arg_max(sell, row(time, coalesce(buy, -1), coalesce(sell, -1))) AS sell
       FROM (SELECT l_partkey AS item_id, strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey % 80000 AS time,
           CASE WHEN l_linenumber <> 1 THEN CAST(trunc(l_extendedprice) AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS buy,
           CASE WHEN l_linenumber <> 2 THEN CAST(trunc(l_extendedprice) AS BIGINT) + 10 ELSE CAST(l_quantity AS BIGINT) + 1 END AS sell
         FROM lineitem) GROUP BY ALL""",
)
# ---- scalar parsing -----------------------------------------------------------------------------

oracle(
    "parse_session_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
)
oracle(
    "parse_duration",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 4000 END AS minutes FROM orders",
)
oracle(
    "lenient_int",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN CAST(trunc(o_totalprice) AS BIGINT)
         WHEN 4 THEN -o_orderkey ELSE 0 END AS n FROM orders""",
)
oracle(
    "first_number",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN -CAST(trunc(o_totalprice) AS BIGINT)
         WHEN 1 THEN CAST(trunc(o_totalprice) AS BIGINT) WHEN 2 THEN 0 WHEN 3 THEN o_orderkey ELSE -o_orderkey END AS n FROM orders""",
)
oracle(
    "parse_money_range",
    """SELECT p_partkey,
         CASE p_partkey % 6 WHEN 0 THEN p_size * 1000 WHEN 1 THEN CAST(trunc(CAST((p_size // 10) || '.' || (p_size % 10) AS DOUBLE) * 1000000) AS BIGINT)
           WHEN 2 THEN p_size * 1000 WHEN 3 THEN least(p_size * 2, p_size * 1000) END AS lo,
         CASE p_partkey % 6 WHEN 0 THEN p_size * 2000 WHEN 1 THEN CAST(trunc(CAST((p_size // 10) || '.' || (p_size % 10) AS DOUBLE) * 1000000) AS BIGINT)
           WHEN 2 THEN p_size * 1000 WHEN 3 THEN greatest(p_size * 2, p_size * 1000) END AS hi
       FROM part""",
)
view("titles", "SELECT page_id, url, trim(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)) AS title FROM pages")
TOKENS = """list_sort(list_distinct(list_transform(list_filter(
    string_split(regexp_replace(regexp_replace(lower({c}), '\\[[^\\]]*\\]|\\([^)]*\\)|\\|[^|]*\\|', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), ' '),
    lambda w : length(w) > 1 AND NOT regexp_full_match(w, '[0-9]+') AND NOT list_contains([{stop}], w)),
    lambda w : CASE WHEN length(w) > 4 AND w LIKE '%s' THEN w[:-2] ELSE w END)))""".replace("{stop}", quoted(STOPWORDS))
oracle("canon_tokens", f"SELECT page_id, coalesce(array_to_string({TOKENS.format(c='title')}, '|'), '') AS tokens FROM titles", "titles")
oracle("norm_name", f"SELECT page_id, coalesce(array_to_string({TOKENS.format(c='title')}, ' '), '') AS norm FROM titles", "titles")
oracle(
    "epoch_text",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M') END AS captured_at FROM events",
)
ITEM = "p_type || ' ' || string_split(p_name, ' ')[2]"
view("creature_items", f"SELECT DISTINCT p_brand || ' ' || p_name AS creature, {ITEM} || CASE WHEN p_partkey % 3 = 0 THEN 's' ELSE '' END AS item FROM part")
view("metadata", f"SELECT CASE WHEN p_partkey % 5 = 0 THEN lower({ITEM}) ELSE {ITEM} END AS name, p_partkey AS id FROM part")
view("named_items", "SELECT lower(name) AS key, max(id) AS id, arg_max(name, id) AS name FROM metadata GROUP BY 1", "metadata")
oracle(
    "name_resolve",
    """SELECT item, coalesce(e.id, s.id) AS id, coalesce(e.name, s.name) AS name
       FROM (SELECT DISTINCT lower(item) AS item FROM creature_items) w LEFT JOIN named_items e ON e.key = item
       LEFT JOIN named_items s ON item LIKE '%s' AND s.key = left(item, length(item) - 1)""",
    "creature_items", "named_items",
)
view(
    "guides",
    """SELECT CASE WHEN s_suppkey % 2 = 0 THEN lower(seg) || ' Nation_' || s_nationkey || ' (team)'
           ELSE 'Nation_' || s_nationkey || ' ' || seg || 's [solo]' END AS spawn,
         CASE WHEN s_suppkey % 11 = 0 THEN '300_up' ELSE ['50_100', '100_200', '200_300'][s_suppkey % 3 + 1] END AS bracket,
         a * 2 AS exp_lo, CASE WHEN s_suppkey % 3 <> 0 THEN a * 3 END AS exp_hi,
         CASE WHEN s_suppkey % 4 <> 0 THEN a END AS lo, CASE WHEN s_suppkey % 7 <> 0 THEN a + 50000 END AS hi,
         'guide ' || (s_nationkey % 4) AS source, CASE WHEN s_nationkey % 5 = 0 THEN '2025-11' ELSE '2026-03' END AS source_date,
         s_suppkey
       FROM (SELECT *, CAST(trunc(s_acctbal * 10) AS BIGINT) AS a,
           ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][s_suppkey % 5 + 1] AS seg FROM supplier)""",
)
view(
    "claims",
    """SELECT title AS spawn, url, CASE WHEN page_id % 6 = 0 THEN '2025' ELSE '2026-02' END AS date,
         CASE page_id % 5 WHEN 0 THEN page_id * 1000 WHEN 1 THEN NULL ELSE (page_id + 1) * 100 END AS lo,
         CASE page_id % 5 WHEN 0 THEN page_id * 2000 WHEN 1 THEN NULL ELSE (page_id + 1) * 100 END AS hi
       FROM titles""",
    "titles",
)
oracle(
    "year_gate",
    """SELECT 'guide' AS kind, spawn, source_date AS date FROM guides WHERE source_date >= '2026'
       UNION ALL SELECT 'community', spawn, date FROM claims WHERE date >= '2026'""",
    "guides", "claims",
)
view("news_days", """
  SELECT o_orderkey, o_orderpriority, unnest(
    CASE o_orderkey % 5
      WHEN 0 THEN CASE WHEN year(day + 3) = year(day) THEN list_transform(range(4), lambda i : day + CAST(i AS INTEGER))
                       ELSE [day, make_date(year(day), month(day + 3), day(day + 3))] END
      WHEN 1 THEN CASE WHEN month(day + 2) = month(day) THEN list_transform(range(3), lambda i : day + CAST(i AS INTEGER)) ELSE [day] END
      WHEN 2 THEN CASE WHEN year(day + 3) = year(day) THEN [day, day + 3]
                       ELSE list_transform(range(day - make_date(year(day), month(day + 3), day(day + 3)) + 1),
                              lambda i : make_date(year(day), month(day + 3), day(day + 3)) + CAST(i AS INTEGER)) END
      WHEN 3 THEN [day] ELSE CAST([] AS DATE[]) END) AS date
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)""")
oracle("event_days_from_text", "SELECT o_orderkey, strftime(date, '%Y-%m-%d') AS date FROM news_days", "news_days")
oracle(
    "kills_per_hour",
    f"""SELECT hunt_id, creature, {ratio('killed * 60', 'minutes', 1)} AS kills_per_h
       FROM kills JOIN sessions ON hunt_id = id""",
    "kills", "sessions",
)
PARTY = """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(s AS BIGINT) AS slot, ['ED', 'EK', 'RP', 'MS', 'EM'][(o_orderkey + s) % 5 + 1] AS voc,
    50 + (o_custkey + s * 7) % 251 AS level,
    CASE WHEN o_orderstatus = 'F' THEN -(s * 100 + o_orderkey % 50) END AS supplies,
    CASE WHEN o_orderstatus = 'F' THEN CAST(trunc(o_totalprice) AS BIGINT) END AS balance_m
  FROM orders, range(1, 5) r(s) WHERE s <= 1 + o_orderkey % 4 AND o_orderstatus IN ('F', 'O')"""
view("party", PARTY)
view(
    "party_sums",
    """SELECT id, count(*) AS n, min(level) AS min_lvl, max(level) AS max_lvl, CAST(round(sum(level) / count(*)) AS BIGINT) AS avg_lvl,
         string_agg(voc || ' ' || level, '+' ORDER BY slot) AS party_comp, -sum(supplies) AS spent FROM party GROUP BY id""",
    "party",
)
oracle(
    "session_loot",
    """SELECT id, balance, CASE WHEN spent IS NULL THEN 0 ELSE 1 END AS supplies_known, coalesce(spent, 0) AS supplies_total,
         balance + coalesce(spent, 0) AS loot_total,
         CASE WHEN minutes > 0 THEN CAST(round((balance + coalesce(spent, 0)) / (minutes / 60.0::DOUBLE)) AS BIGINT) ELSE balance END AS loot_h
       FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id, -CAST(trunc(o_totalprice) AS BIGINT) AS balance, o_orderkey % 90 AS minutes FROM orders)
       LEFT JOIN party_sums USING (id)""",
    "party_sums",
)
oracle(
    "level_fallback",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(n, [1, 2, 3, 0][o_orderkey % 4 + 1]) AS party_size, coalesce(avg_lvl, 150) AS avg_lvl
       FROM orders LEFT JOIN party_sums ON id = CAST(o_orderkey AS VARCHAR)""",
    "party_sums",
)
oracle(
    "party_label_size",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, [1, 2, 3, 0][o_orderkey % 4 + 1] AS size, 150 AS middle FROM orders",
)
oracle(
    "loot_rate",
    "SELECT id, CASE WHEN minutes > 0 THEN CAST(round(loot_h / (minutes / 60.0::DOUBLE)) AS BIGINT) ELSE balance_h END AS rate FROM sessions",
    "sessions",
)
oracle(
    "confidence_band",
    """SELECT o_orderkey, CASE WHEN p <= 50 THEN 'high' WHEN p <= 120 THEN 'medium' ELSE 'low' END AS band
       FROM (SELECT o_orderkey, round(round(o_totalprice / 200000, 2) * 100) AS p FROM orders)""",
)
def substance(c: str) -> str:
    present = " + ".join(f"CAST(contains(lower({c}), '{w}') AS BIGINT)" for w in PLACE_WORDS)
    rates = f"2 * len(regexp_extract_all({c}, '(?i){MONEY_RATE}'))"
    return f"CAST({present} + {rates} + CAST(regexp_matches(lower({c}), '{LEVEL_MENTION}') AS BIGINT) AS BIGINT)"


view(
    "posts",
    """SELECT doc_id AS id, source AS title, n_chars % 100 AS score, doc_id % 40 AS num_comments,
         CASE WHEN doc_id % 9 = 0 THEN text || chr(10) || 'made ' || doc_id || 'k/h at level 120 ek' ELSE text END AS selftext FROM documents""",
)
oracle("content_score", f"SELECT id, {substance('selftext')} AS substance FROM posts", "posts")

# ---- extraction ---------------------------------------------------------------------------------

oracle("page_links", "SELECT DISTINCT unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS href FROM pages")
oracle(
    "page_fields",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, spawn || ' & co' AS spawn, strftime(o_orderdate, '%b %d, %Y %H:%M') AS date_text,
         lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || 'h' AS duration, m AS minutes,
         t * 3 AS xp_gain, t * 2 AS raw_xp_gain, -t AS balance, t * 10 AS xp_h, t * 5 AS raw_xp_h, t AS balance_h
       FROM (SELECT *, o_orderkey % 90 AS m, CAST(trunc(o_totalprice) AS BIGINT) AS t FROM places)""",
    "places",
)
oracle(
    "page_table_rows",
    """SELECT p.*, {'ED': 'Elder Druid', 'EK': 'Elite Knight', 'RP': 'Royal Paladin', 'MS': 'Master Sorcerer', 'EM': 'Exalted Monk'}[voc] AS voc_name
       FROM party p""".replace("{'ED'", "MAP {'ED'"),
    "party",
)
oracle(
    "page_kill_rows",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Beast ' || s || ' & kin' AS creature, 1000 * s + o_orderkey % 1000 AS killed
       FROM orders, range(1, 5) r(s) WHERE s <= 1 + o_orderkey % 4""",
)
oracle(
    "party_rollup",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(n, [1, 2, 3, 0][o_orderkey % 4 + 1]) AS party_size, min_lvl, max_lvl,
         coalesce(avg_lvl, 150) AS avg_lvl, coalesce(party_comp, '') AS party_comp, 1 AS has_creature_stats
       FROM orders LEFT JOIN party_sums ON id = CAST(o_orderkey AS VARCHAR)""",
    "party_sums",
)
oracle(
    "wiki_materials",
    """SELECT item, imbuement, tier, min(qty) AS qty FROM (
         SELECT p_name AS item, p_brand AS imbuement, ['Basic', 'Intricate', 'Powerful'][p_size % 3 + 1] AS tier, CAST(p_size AS BIGINT) AS qty FROM part
         UNION ALL SELECT p_type, p_brand, ['Basic', 'Intricate', 'Powerful'][p_size % 3 + 1], p_size + 5 FROM part) GROUP BY ALL""",
)
TABS = "[" + quoted(DELIVERY_TABS) + "]"
oracle(
    "tabbed_rows",
    f"""SELECT p_name AS item, {TABS}[p_partkey % 9 + 1] AS npc, p_size * 1000 + p_partkey % 1000 AS npc_price, 'Very High' AS market_band FROM part
       UNION ALL SELECT p_type, {TABS}[(p_partkey + 4) % 9 + 1], p_size * 1000 + p_partkey % 1000, 'Low' FROM part""",
)

oracle(
    "capture_build",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'https://example.org/s/' || o_orderkey AS url, spawn || ' & co' AS spawn, o_orderkey % 90 AS minutes,
         coalesce(n, CASE run WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END) AS party_size,
         coalesce(avg_lvl, CASE run WHEN 1 THEN 150 WHEN 2 THEN 175 END) AS avg_lvl, -CAST(trunc(o_totalprice) AS BIGINT) AS balance,
         coalesce(spent, 0) AS supplies_total, [100, 50, 0][run] AS query_min, [201, 301, 0][run] AS query_max, ['', '', 'quara'][run] AS query_search,
         coalesce(n, 0) AS members, levels, 1 + o_orderkey % 4 AS creatures,
         CAST((1 + o_orderkey % 4) * (2 + o_orderkey % 4) * 500 + (1 + o_orderkey % 4) * (o_orderkey % 1000) AS BIGINT) AS killed
       FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1 END AS run FROM places)
       LEFT JOIN party_sums ON id = CAST(o_orderkey AS VARCHAR)
       LEFT JOIN (SELECT id AS lid, CAST(sum(level) AS BIGINT) AS levels FROM party GROUP BY id) ON lid = CAST(o_orderkey AS VARCHAR) WHERE run IS NOT NULL""",
    "places", "party_sums", "party",
)

# ---- filters and joins --------------------------------------------------------------------------

oracle(
    "recent_sessions",
    "SELECT id, spawn, strftime(hunt_date, '%Y-%m-%d') AS hunt_date, d - hunt_date AS age FROM sessions, as_of WHERE d - hunt_date <= 60",
    "sessions", "as_of",
)
oracle("exclude_events", "SELECT id, spawn, strftime(hunt_date, '%Y-%m-%d') AS hunt_date FROM profit_sessions", "profit_sessions")
oracle(
    "event_flags",
    "SELECT id, CASE WHEN hunt_date IN (SELECT date FROM event_days) THEN 1 ELSE 0 END AS event_flag FROM fresh365",
    "fresh365", "event_days",
)
oracle("bracket_rankings", "SELECT bracket, rank, id, spawn, loot_h, avg_lvl FROM profit_ranked WHERE bracket <> 'all'", "profit_ranked")
view(
    "offers",
    """SELECT l_partkey AS item_id, CASE WHEN l_returnflag = 'N' THEN 'sell' ELSE 'buy' END AS side,
         CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS price, CAST(l_quantity AS BIGINT) AS units,
         l_suppkey % 10 = 0 AS anonymous, l_shipdate AS captured, l_linestatus FROM lineitem""",
)
view(
    "average_prices",
    """SELECT item_id,
         coalesce(nullif(CASE WHEN item_id % 7 = 0 THEN 0 ELSE sum(price) FILTER (sell AND closed) // count(*) FILTER (sell AND closed) END, 0),
                  sum(price) FILTER (sell) // count(*) FILTER (sell), 0) AS avg_sell,
         coalesce(nullif(CASE WHEN item_id % 7 = 0 THEN 0 ELSE sum(price) FILTER (NOT sell AND closed) // count(*) FILTER (NOT sell AND closed) END, 0),
                  sum(price) FILTER (NOT sell) // count(*) FILTER (NOT sell), 0) AS avg_buy
       FROM (SELECT *, side = 'sell' AS sell, l_linestatus = 'F' AS closed FROM offers) GROUP BY item_id""",
    "offers",
)
view(
    "judged",
    """SELECT o.*, p_size, coalesce(CASE WHEN side = 'sell' THEN avg_sell > 0 AND price * 100 >= avg_sell * 125
           ELSE avg_buy > 0 AND price * 100 <= avg_buy * 75 END, false) AS unfair,
         price > 0 AND NOT unfair AND NOT (side = 'sell' AND p_size = 1 AND price > 2500) AND NOT (p_size = 2 AND anonymous) AS kept
       FROM offers o JOIN part ON item_id = p_partkey JOIN average_prices USING (item_id)""",
    "offers", "average_prices",
)
oracle("red_filter", "SELECT item_id, side, count(*) AS offers, count(*) FILTER (unfair) AS unfair FROM judged GROUP BY ALL", "judged")
oracle(
    "keyword_filter",
    "SELECT o_orderkey, 'Double XP and rapid respawn' AS title FROM orders WHERE o_orderpriority = '1-URGENT'",
)
oracle(
    "ranking_view",
    """SELECT rank, id, spawn, xp_h FROM exp_ranked
       WHERE bracket = '100_200' AND party_size >= 2 AND contains(lower(spawn), 'household')""",
    "exp_ranked",
)
oracle(
    "kills_enriched",
    f"""SELECT hunt_id, spawn, strftime(hunt_date, '%Y-%m-%d') AS hunt_date, minutes, creature, killed,
         {ratio('killed * 60', 'minutes', 1)} AS kills_per_h, xp_h, loot_h, balance_h, url
       FROM kills JOIN exp_sessions ON hunt_id = id""",
    "kills", "exp_sessions",
)
oracle(
    "bracket_kills",
    "SELECT * FROM kills WHERE hunt_id IN (SELECT id FROM profit_brackets WHERE bracket = '100_200')",
    "kills", "profit_brackets",
)
view(
    "pending",
    """SELECT DISTINCT creature FROM kills WHERE hunt_id IN (SELECT id FROM profit_sessions)
         AND creature NOT IN (SELECT creature FROM creature_items WHERE item LIKE 'SMALL%')""",
    "kills", "profit_sessions", "creature_items",
)
oracle("pending_keys", "SELECT creature FROM pending", "pending")
oracle(
    "retry_cooldown",
    """SELECT creature FROM pending WHERE creature NOT IN (
         SELECT creature FROM lineitem JOIN creature_parts ON l_partkey = p_partkey, as_of
         WHERE l_returnflag = 'R' GROUP BY creature, d HAVING d - max(CAST(l_shipdate AS DATE)) < 7)""",
    "pending", "creature_parts", "as_of",
)

# ---- prices -------------------------------------------------------------------------------------

view("ladder", "SELECT item_id, side, price, CAST(sum(units) AS BIGINT) AS units FROM judged WHERE kept GROUP BY ALL", "judged")
oracle("ladder_long", "SELECT item_id, side, price, CAST(sum(units) AS BIGINT) AS units, count(*) AS offers FROM judged WHERE kept GROUP BY ALL", "judged")
view(
    "fair",
    """SELECT item_id, CAST(sum(price * kept) // nullif(sum(kept), 0) AS BIGINT) AS fair FROM (
         SELECT item_id, price, greatest(0, 10000 * cum - greatest(10000 * (cum - units), total * 500)) AS kept FROM (
           SELECT *, CAST(sum(units) OVER (PARTITION BY item_id ORDER BY price DESC) AS HUGEINT) AS cum,
             CAST(sum(units) OVER (PARTITION BY item_id) AS HUGEINT) AS total FROM ladder WHERE side = 'buy')) GROUP BY item_id""",
    "ladder",
)
oracle("trimmed_vwap", "SELECT * FROM fair", "fair")
view(
    "shelf",
    """SELECT item_id, CAST(sum(price * units) FILTER (abs(price - level) * 100 <= level) // sum(units) FILTER (abs(price - level) * 100 <= level) AS BIGINT) AS shelf,
         any_value(level_units) AS shelf_units
       FROM ladder JOIN (SELECT item_id, arg_max(price, row(units, -price)) AS level, max(units) AS level_units FROM ladder WHERE side = 'sell' GROUP BY item_id)
         USING (item_id) WHERE side = 'sell' GROUP BY item_id""",
    "ladder",
)
oracle("shelf_price", "SELECT * FROM shelf", "shelf")
view(
    "p25",
    """SELECT item_id, min(price) FILTER (cum * 4 >= total) AS p25 FROM (
         SELECT *, sum(units) OVER (PARTITION BY item_id ORDER BY price) AS cum, sum(units) OVER (PARTITION BY item_id) AS total
         FROM ladder WHERE side = 'sell') GROUP BY item_id""",
    "ladder",
)
oracle("weighted_quantile", "SELECT * FROM p25", "p25")
view(
    "depth",
    """SELECT item_id, coalesce(sum(units) FILTER (price * 10 BETWEEN fair * 9 AND fair * 11), 0) AS depth_units
       FROM ladder JOIN fair USING (item_id) WHERE fair <> 0 GROUP BY item_id""",
    "ladder", "fair",
)
oracle("depth_band", "SELECT * FROM depth", "depth")
view(
    "prices",
    f"""SELECT b.item_id, patient - 1 AS instant, top_buy, fair, shelf, shelf_units, patient,
         {ratio('p25 - fair', 'fair', 3)} AS upside, depth_units, n_sell, n_buy, n_sell_red,
         strftime(captured, '%Y-%m-%d %H:%M') AS captured_at, m.name AS item
       FROM (SELECT item_id, min(price) FILTER (kept AND side = 'sell') AS patient, max(price) FILTER (kept AND side = 'buy') AS top_buy,
               count(*) FILTER (kept AND side = 'sell') AS n_sell, count(*) FILTER (kept AND side = 'buy') AS n_buy,
               count(*) FILTER (NOT kept AND side = 'sell') AS n_sell_red, max(captured) AS captured
             FROM judged WHERE price > 0 GROUP BY item_id HAVING n_sell > 0 OR n_buy > 0) b
       LEFT JOIN fair USING (item_id) LEFT JOIN shelf USING (item_id) LEFT JOIN p25 USING (item_id) LEFT JOIN depth USING (item_id)
       LEFT JOIN metadata m ON m.id = b.item_id""",
    "judged", "fair", "shelf", "p25", "depth", "metadata",
)
oracle("price_stats", "SELECT * FROM prices", "prices")
oracle(
    "book_merge",
    """SELECT item_id, strftime(m, '%Y-%m-%d') AS capture_date, count(*) AS offers, sum(units) AS units
       FROM (SELECT *, date_trunc('month', captured) AS m FROM offers)
       WHERE m IN (SELECT DISTINCT date_trunc('month', captured) AS m FROM offers ORDER BY m DESC LIMIT 7)
       GROUP BY item_id, m QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY m DESC) = 1""",
    "offers",
)
view(
    "volumes",
    """SELECT item_id, max(sold + bought) AS volume FROM (
         SELECT l_partkey AS item_id, year(l_shipdate) AS y, coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'N'), 0) AS sold,
           coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag <> 'N'), 0) AS bought
         FROM lineitem GROUP BY ALL) WHERE y IN (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem ORDER BY y DESC LIMIT 2) GROUP BY item_id""",
)
oracle("item_volume", "SELECT * FROM volumes", "volumes")
oracle(
    "volume_topn",
    """SELECT item_id, volume, position FROM (SELECT *, row_number() OVER (ORDER BY volume DESC, item_id) AS position FROM volumes)
       WHERE position <= 40 OR (position <= 150 AND item_id NOT IN (SELECT p_partkey FROM part WHERE p_size <= 2))""",
    "volumes",
)
oracle(
    "quota_select",
    f"""SELECT *, row_number() OVER (ORDER BY watched DESC, CASE WHEN watched = 0 THEN volume END DESC NULLS LAST, name, item_id) AS position
       FROM (SELECT p_partkey AS item_id, lower({ITEM}) AS name, CASE WHEN p_size = 1 AND p_brand = 'Brand#2' THEN 1 ELSE 0 END AS watched,
           coalesce(volume, 0) AS volume FROM part LEFT JOIN volumes ON item_id = p_partkey) QUALIFY position <= 300""",
    "volumes",
)

_WANTED = f"SELECT p_partkey AS item_id, lower({ITEM}) AS name, CASE WHEN p_size = 1 AND p_brand = 'Brand#2' THEN 1 ELSE 0 END AS watched FROM part"
view("full_quota", f"SELECT *, row_number() OVER (ORDER BY watched DESC, name, item_id) AS position FROM ({_WANTED}) QUALIFY position <= 300")
oracle("quota_full", "SELECT * FROM full_quota", "full_quota")
view(
    "target_items",
    f"""SELECT coalesce(e.id, s.id) AS item_id, max(watched) AS watched, min(w.name) AS name
       FROM (SELECT lower({ITEM}) || CASE WHEN p_partkey % 2 = 0 THEN 's' ELSE '' END AS name, 1 AS watched FROM part WHERE p_size = 1 AND p_brand = 'Brand#2'
             UNION ALL SELECT lower(item), 0 FROM creature_items) w
       LEFT JOIN named_items e ON e.key = w.name LEFT JOIN named_items s ON w.name LIKE '%s' AND s.key = left(w.name, length(w.name) - 1)
       GROUP BY 1 HAVING item_id IS NOT NULL""",
    "creature_items", "named_items",
)
view(
    "target_quota",
    """SELECT item_id, t.name, watched, coalesce(volume, 0) AS volume, position FROM (
         SELECT *, row_number() OVER (ORDER BY watched DESC, name, item_id) AS position FROM target_items) t
       LEFT JOIN volumes USING (item_id) WHERE position <= 300""",
    "target_items", "volumes",
)
_HELD = "item_id IN (SELECT p_partkey FROM part WHERE p_size <= 2)"
oracle("order_targets_full", f"SELECT * FROM target_quota WHERE NOT {_HELD}", "target_quota")
oracle(
    "order_targets",
    f"""SELECT * FROM (SELECT item_id, name, watched, volume,
           row_number() OVER (ORDER BY watched DESC, CASE WHEN watched = 0 THEN volume END DESC NULLS LAST, name, item_id) AS position
         FROM target_quota) WHERE position <= 40 AND NOT {_HELD}""",
    "target_quota",
)
oracle(
    "lookup_cache",
    """SELECT creature, n_items, CASE WHEN n_items IS NULL THEN 'failed' ELSE 'held' END AS state,
         strftime(d - CASE WHEN md5(creature) < '8' THEN 10 ELSE 5 END, '%Y-%m-%d') AS noted_on
       FROM (SELECT DISTINCT creature FROM kills) LEFT JOIN (
         SELECT creature, count(DISTINCT item) AS n_items FROM creature_items WHERE item NOT LIKE 'SMALL%' GROUP BY creature) USING (creature), as_of""",
    "kills", "creature_items", "as_of",
)
oracle(
    "quota_daily",
    """SELECT item_id, name, watched, coalesce(volume, 0) AS volume,
         row_number() OVER (ORDER BY watched DESC, CASE WHEN watched = 0 THEN coalesce(volume, 0) END DESC NULLS LAST, name, item_id) AS position
       FROM full_quota LEFT JOIN volumes USING (item_id) QUALIFY row_number() OVER (ORDER BY watched DESC, CASE WHEN watched = 0 THEN coalesce(volume, 0) END DESC NULLS LAST, name, item_id) <= 40""",
    "full_quota", "volumes",
)

# ---- demand -------------------------------------------------------------------------------------

view("name_prices", "SELECT * FROM prices WHERE item IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lower(item) ORDER BY item_id DESC) = 1", "prices")
oracle(
    "digits_only",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(trunc(o_totalprice) AS BIGINT) WHEN 1 THEN CAST(round(o_totalprice * 100) AS BIGINT)
         WHEN 3 THEN o_orderkey WHEN 4 THEN o_orderkey * 100 + 75 END AS digits FROM orders""",
)
oracle(
    "delivery_sheet",
    f"""SELECT {ITEM} || ' crate' AS item, p_brand || ' ' || p_name AS creatures, CASE WHEN p_brand <> 'Brand#2' THEN p_brand ELSE '' END AS npc,
         CASE WHEN p_size % 5 <> 0 THEN p_size * 100 END AS npc_price, '10-20' AS qty
       FROM part WHERE p_size >= 26 AND length({ITEM} || ' crate') % 4 <> 0""",
)
view(
    "imbuing",
    f"""SELECT lower({ITEM}) AS item_key, ['Basic', 'Intricate', 'Powerful'][p_size % 3 + 1] || ' ' || p_brand || ' x' || (p_size % 3 * 10 + 5) AS label
       FROM part WHERE p_size <= 30""",
)
view(
    "delivery",
    f"""SELECT {ITEM} AS item, {TABS}[p_partkey % 9 + 1] AS npc, CAST(trunc(p_retailprice) AS BIGINT) AS npc_price,
         ['Low', 'Mid', 'High'][p_size % 3 + 1] AS band FROM part WHERE p_size >= 21
       UNION ALL SELECT {ITEM} || ' crate', p_brand, CASE WHEN p_size % 5 <> 0 THEN p_size * 100 END, NULL FROM part WHERE p_size >= 26""",
)
view(
    "tags",
    """SELECT coalesce(pr.item, delivery_name, item_key) AS item, fair, coalesce(imbuements, '') AS imbuements,
         coalesce(delivery_npcs, '') AS delivery_npcs, coalesce(delivery_bands, '') AS delivery_bands, npc_price
       FROM (SELECT item_key, string_agg(DISTINCT label, '|' ORDER BY label) AS imbuements FROM imbuing GROUP BY 1)
       FULL JOIN (SELECT lower(item) AS item_key, min(item) AS delivery_name, max(nullif(npc_price, 0)) AS npc_price,
           string_agg(DISTINCT n, '|' ORDER BY n) AS delivery_npcs, string_agg(DISTINCT band, '|' ORDER BY band) AS delivery_bands
           FROM (SELECT *, CASE npc WHEN 'RashidTab' THEN 'Rashid' WHEN 'Everything' THEN NULL ELSE npc END AS n FROM delivery) GROUP BY 1) USING (item_key)
       LEFT JOIN name_prices pr ON lower(pr.item) = item_key""",
    "imbuing", "delivery", "name_prices",
)
oracle("item_tags", "SELECT * FROM tags", "tags")
oracle(
    "demand_view",
    "SELECT item, fair, delivery_npcs, npc_price FROM tags WHERE delivery_npcs <> '' AND contains(lower(item), 'e')",
    "tags",
)
oracle(
    "item_labels",
    """SELECT DISTINCT item_key, 'imbuement' AS kind, label FROM imbuing WHERE label <> ''
       UNION ALL SELECT DISTINCT lower(item), 'buyer', CASE npc WHEN 'RashidTab' THEN 'Rashid' ELSE npc END FROM delivery WHERE npc NOT IN ('Everything', '')
       UNION ALL SELECT DISTINCT lower(item), 'band', band FROM delivery WHERE band <> ''""",
    "imbuing", "delivery",
)
oracle("distinct_names", "SELECT DISTINCT lower(item) AS item FROM creature_items", "creature_items")
view(
    "marks",
    """SELECT item_key, max(i) || max(d) AS tag FROM (
         SELECT item_key, '🧪' AS i, '' AS d FROM imbuing UNION ALL SELECT lower(item), '', '📦' FROM delivery) GROUP BY 1""",
    "imbuing", "delivery",
)
view(
    "loot_texts",
    """SELECT creature, string_agg(item || '|' || coalesce(CAST(fair AS VARCHAR), '—') || '|' || coalesce(tag, ''), '|' ORDER BY worth DESC, item DESC) AS top_loot
       FROM (SELECT creature, c.item, coalesce(e.fair, CASE WHEN e.item IS NULL THEN s.fair END) AS fair, coalesce(coalesce(e.fair, CASE WHEN e.item IS NULL THEN s.fair END), -1) AS worth, tag
         FROM creature_items c LEFT JOIN name_prices e ON lower(e.item) = lower(c.item)
         LEFT JOIN name_prices s ON c.item LIKE '%s' AND lower(s.item) = lower(left(c.item, length(c.item) - 1))
         LEFT JOIN marks ON item_key = lower(c.item)
         QUALIFY row_number() OVER (PARTITION BY creature ORDER BY worth DESC, c.item DESC) <= 4) GROUP BY creature""",
    "creature_items", "name_prices", "marks",
)
oracle("topk_per_group", "SELECT * FROM loot_texts", "loot_texts")

# ---- statistics ---------------------------------------------------------------------------------

oracle("spawn_stats", STATS.format(keys="spawn", source="profit_sessions"), "profit_sessions")
oracle("spawn_stats_brackets", "SELECT * FROM bracket_stats", "bracket_stats")
oracle(
    "kpi_best",
    """SELECT 'median_xp_h' AS metric, arg_min(spawn, row(-median_xp_h, spawn)) AS spawn, max(median_xp_h) AS value, arg_min(n_hunts, row(-median_xp_h, spawn)) AS n_hunts
       FROM bracket_stats WHERE bracket = '100_200'
       UNION ALL SELECT 'median_profit_h', arg_min(spawn, row(-median_profit_h, spawn)), max(median_profit_h), arg_min(n_hunts, row(-median_profit_h, spawn))
       FROM bracket_stats WHERE bracket = '100_200'""",
    "bracket_stats",
)
oracle(
    "weighted_median",
    """SELECT p_brand, y, coalesce(min(v) FILTER (cum * 2 >= total), 0) AS wmedian FROM (
         SELECT *, sum(w) OVER (PARTITION BY p_brand, y ORDER BY v) AS cum, sum(w) OVER (PARTITION BY p_brand, y) AS total FROM (
           SELECT p_brand, year(l_shipdate) AS y, CAST(floor(l_extendedprice) AS BIGINT) AS v, CAST(l_quantity AS BIGINT) AS w
           FROM lineitem JOIN part ON l_partkey = p_partkey)) GROUP BY ALL""",
)
view(
    "observations",
    """SELECT creature, hunt_id, url, loot_h * minutes / (total * 60.0::DOUBLE) AS v, CAST(round(killed / total * 1e15) AS HUGEINT) AS w
       FROM (SELECT k.*, s.*, CAST(sum(killed) OVER (PARTITION BY hunt_id) AS BIGINT) AS total FROM kills k JOIN calibration s ON hunt_id = id WHERE killed > 0 AND loot_h > 0)""",
    "kills", "calibration",
)
view(
    "kill_values",
    """SELECT creature, count(*) AS n_sessions, CAST(trunc(min(v) FILTER (2 * cum >= total - n)) AS BIGINT) AS value_per_kill,
         CAST(trunc(min(v)) AS BIGINT) AS min_v, CAST(trunc(max(v)) AS BIGINT) AS max_v, string_agg(url, '|' ORDER BY hunt_id) FILTER (r <= 5) AS sample_urls
       FROM (SELECT *, sum(w) OVER (PARTITION BY creature ORDER BY v) AS cum, sum(w) OVER (PARTITION BY creature) AS total,
               count(*) OVER (PARTITION BY creature) AS n, row_number() OVER (PARTITION BY creature ORDER BY hunt_id) AS r FROM observations) GROUP BY creature""",
    "observations",
)
oracle("value_per_kill", "SELECT * FROM kill_values", "kill_values")
view(
    "calibration_brackets",
    """SELECT 'all' AS bracket, * FROM calibration UNION ALL
       SELECT bracket, s.* FROM calibration s JOIN brackets ON avg_lvl <> 0 AND avg_lvl BETWEEN lo AND hi, as_of WHERE hunt_date >= d - 60""",
    "calibration", "brackets", "as_of",
)
view(
    "rates",
    """SELECT bracket, spawn, creature, hunt_id, loot_h, CAST(round(killed * 60000000000.0::DOUBLE / minutes) AS HUGEINT) AS rate
       FROM kills JOIN calibration_brackets ON hunt_id = id WHERE killed > 0""",
    "kills", "calibration_brackets",
)
view(
    "mean_rates",
    """SELECT bracket, spawn, creature, count(*) AS n_sessions, (2 * sum(rate) + count(*)) // (2 * count(*)) AS avg_rate, any_value(value_per_kill) AS value_per_kill
       FROM rates LEFT JOIN kill_values USING (creature) GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY bracket, spawn, creature"),
    "rates", "kill_values",
)
view(
    "computed",
    f"""SELECT bracket, spawn, CAST(coalesce(trunc_div, 0) AS BIGINT) AS profit_computed_h, coverage, n_sessions, measured_loot_h, coalesce(valued, '') AS valued, coalesce(missing, '') AS missing
       FROM (SELECT bracket, spawn,
           sign(sum(avg_rate * value_per_kill)) * (abs(sum(avg_rate * value_per_kill)) // 1000000000) AS trunc_div,
           {ratio('coalesce(sum(avg_rate) FILTER (value_per_kill IS NOT NULL), 0)', 'sum(avg_rate)', 2)} AS coverage,
           string_agg(t, ';' ORDER BY t) FILTER (value_per_kill IS NOT NULL AND r <= 10) AS valued,
           string_agg(creature, '|' ORDER BY creature) FILTER (value_per_kill IS NULL AND r <= 10) AS missing
         FROM (SELECT *, row_number() OVER (PARTITION BY bracket, spawn, value_per_kill IS NULL ORDER BY t) AS r FROM (
           SELECT *, CASE WHEN value_per_kill IS NULL THEN creature ELSE creature || ' ' || CAST({ratio('avg_rate', '1000000000', 0)} AS BIGINT) || '/h×' || value_per_kill END AS t FROM mean_rates))
         GROUP BY ALL)
       JOIN (SELECT bracket, spawn, count(*) AS n_sessions, CAST(trunc(median(loot_h) FILTER (loot_h <> 0)) AS BIGINT) AS measured_loot_h
         FROM (SELECT DISTINCT bracket, spawn, hunt_id, loot_h FROM rates) GROUP BY ALL) USING (bracket, spawn)""",
    "mean_rates", "rates",
)
oracle("spawn_profit", "SELECT * FROM computed", "computed")
oracle(
    "spawn_loot",
    f"""SELECT spawn, creature, {ratio('avg_rate', '1000000000', 1)} AS avg_kills_h, n_sessions, value_per_kill,
         CAST(sign(avg_rate * value_per_kill) * (abs(avg_rate * value_per_kill) // 1000000000) AS BIGINT) AS contrib_h, top_loot
       FROM mean_rates LEFT JOIN loot_texts USING (creature) WHERE bracket = 'all'""",
    "mean_rates", "loot_texts",
)
view("met", "SELECT DISTINCT spawn, creature FROM kills JOIN sessions ON hunt_id = id", "kills", "sessions")
view(
    "met_sessions",
    "SELECT spawn, count(DISTINCT hunt_id) AS n_sessions_spawn FROM kills JOIN sessions ON hunt_id = id GROUP BY spawn",
    "kills", "sessions",
)
view(
    "listed",
    """SELECT spawn, item, string_agg(creature, '|' ORDER BY creature) AS creatures FROM (
         SELECT spawn, item, creature FROM met JOIN creature_items USING (creature)
         QUALIFY row_number() OVER (PARTITION BY spawn, item ORDER BY creature) <= 6) GROUP BY ALL""",
    "met", "creature_items",
)
oracle(
    "spawn_items",
    """SELECT spawn, l.item, coalesce(e.id, s.id) AS item_id, p.instant, p.fair, p.patient, p.captured_at AS price_date, n_sessions_spawn, creatures
       FROM listed l JOIN met_sessions USING (spawn) LEFT JOIN named_items e ON e.key = lower(l.item)
       LEFT JOIN named_items s ON l.item LIKE '%s' AND s.key = lower(left(l.item, length(l.item) - 1))
       LEFT JOIN name_prices p ON lower(p.item) = coalesce(e.key, s.key)""",
    "listed", "met_sessions", "named_items", "name_prices",
)
oracle(
    "mode_name",
    """SELECT spawn, creature FROM (SELECT spawn, creature, count(*) AS n FROM kills JOIN sessions ON hunt_id = id GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY spawn ORDER BY n DESC, creature) = 1""",
    "kills", "sessions",
)
oracle(
    "kill_share",
    "SELECT hunt_id, creature, killed, round(killed / CAST(sum(killed) OVER (PARTITION BY hunt_id) AS BIGINT), 6) AS share FROM kills WHERE killed > 0",
    "kills",
)
oracle(
    "pct_of_max",
    """SELECT id, spawn, xp_h, row_number() OVER (ORDER BY xp_h DESC, id) AS position,
         CAST(greatest(1, round(xp_h / greatest(1, max(xp_h) OVER ()) * 100)) AS BIGINT) AS pct
       FROM (SELECT id, spawn, xp_h FROM exp_sessions ORDER BY xp_h DESC, id LIMIT 10)""",
    "exp_sessions",
)
oracle(
    "top_sessions",
    """SELECT 'xp_h' AS metric, bracket, rank, id, xp_h, loot_h FROM exp_ranked
       UNION ALL SELECT 'loot_h', bracket, rank, id, xp_h, loot_h FROM profit_ranked""",
    "exp_ranked", "profit_ranked",
)

# ---- texts --------------------------------------------------------------------------------------

oracle(
    "discussed_posts",
    "SELECT row_number() OVER (ORDER BY heat DESC, id) AS position, id, heat FROM (SELECT id, score + 2 * num_comments AS heat FROM posts) QUALIFY position <= 60",
    "posts",
)
oracle(
    "content_rank",
    f"""SELECT row_number() OVER (ORDER BY substance DESC, score DESC, kind, id) AS position, * FROM (
         SELECT *, {substance('body')} AS substance FROM (
           SELECT 'POST' AS kind, CAST(id AS VARCHAR) AS id, score, title, title || chr(10) || selftext AS body, 'https://example.org/post/' || id AS url
             FROM posts WHERE length(trim(title || chr(10) || selftext)) > 80
           UNION ALL SELECT 'COMM', conv_id || '/' || turn, conv_id % 30, '', text, '' FROM conversations WHERE length(text) > 120)) QUALIFY position <= 70""",
    "posts",
)
oracle(
    "event_days",
    """SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date FROM (
         SELECT date FROM news_days JOIN orders USING (o_orderkey)
         WHERE year(o_orderdate) IN (SELECT DISTINCT year(o_orderdate) AS y FROM news_days JOIN orders USING (o_orderkey) ORDER BY y DESC LIMIT 4)
         UNION ALL SELECT unnest([DATE '2026-09-05', DATE '2026-09-06']))""",
    "news_days",
)
oracle(
    "days_from_news",
    "SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date, 'Double XP and rapid respawn' AS name FROM news_days WHERE o_orderpriority = '1-URGENT'",
    "news_days",
)

# ---- incremental --------------------------------------------------------------------------------

oracle(
    "stream_upsert",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
oracle(
    "stream_append",
    """SELECT user_id, event_id, event_type FROM events, (SELECT min(event_id) AS low, (max(event_id) - min(event_id)) // 3 + 1 AS step FROM events)
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_id - low) // step, ts, event_id) = 1""",
)
oracle(
    "stream_dedup",
    """SELECT event_id, event_type FROM events UNION ALL
       SELECT event_id, event_type FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS second FROM events),
         (SELECT min(CAST(floor(epoch(ts)) AS BIGINT)) AS low, max(CAST(floor(epoch(ts)) AS BIGINT)) AS high FROM events)
       WHERE event_type = 'error' AND (second - low) % ((high - low) // 3 + 1) >= ((high - low) // 3 + 1) - ((high - low) // 3 + 1) // 6
         AND (second - low) // ((high - low) // 3 + 1) < 2""",
)
oracle("captures_fold", "SELECT * EXCLUDE (value) FROM (" + USERS.format(where="") + ")")
oracle(
    "append_new",
    """WITH m AS (SELECT min(ts) + to_seconds(date_diff('second', min(ts), max(ts)) // 2) AS t FROM events)
       SELECT user_id + CASE WHEN event_type = 'error' THEN 1000000 ELSE 0 END AS user_id, event_id, event_type FROM events, m
       WHERE ts >= t AND user_id + CASE WHEN event_type = 'error' THEN 1000000 ELSE 0 END NOT IN (SELECT user_id FROM events, m WHERE ts < t)
       QUALIFY row_number() OVER (PARTITION BY user_id + CASE WHEN event_type = 'error' THEN 1000000 ELSE 0 END ORDER BY ts, event_id) = 1""",
)

# ---- names and consensus ------------------------------------------------------------------------

view("names", "SELECT title AS name FROM titles UNION SELECT p_type || ' ' || p_name FROM part", "titles")
view("keyed", f"SELECT name, coalesce({TOKENS.format(c='name')}, []) AS tokens FROM names", "names")
view(
    "similar_keys",
    """SELECT a, b FROM (SELECT DISTINCT array_to_string(tokens, ' ') AS a, tokens AS ta FROM keyed WHERE len(tokens) > 0) x
       JOIN (SELECT DISTINCT array_to_string(tokens, ' ') AS b, tokens AS tb FROM keyed WHERE len(tokens) > 0) y ON a < b
       WHERE len(list_intersect(ta, tb)) / (len(ta) + len(tb) - len(list_intersect(ta, tb))) >= 0.5""",
    "keyed",
)
oracle("similar_names", "SELECT a, b FROM similar_keys", "similar_keys")


def reach(name: str, nodes: str, links: str, *needs: str) -> None:
    """Smallest reachable node of each node, by walking the links both ways."""
    view(
        f"{name}_reach",
        f"""SELECT n AS node, n AS seen FROM {nodes} UNION
            SELECT r.node, CASE WHEN l.a = r.seen THEN l.b ELSE l.a END FROM {name}_reach r JOIN {links} l ON l.a = r.seen OR l.b = r.seen""",
        *needs,
    )
    view(f"{name}_root", f"SELECT node, min(seen) AS root FROM {name}_reach GROUP BY node", f"{name}_reach")


view("title_nodes", "SELECT DISTINCT array_to_string(tokens, ' ') AS n FROM keyed WHERE len(tokens) > 0", "keyed")
reach("title", "title_nodes", "similar_keys", "title_nodes", "similar_keys")
oracle(
    "name_clusters",
    """SELECT name, CASE WHEN root IS NULL THEN name ELSE min(name) OVER (PARTITION BY root) END AS cluster
       FROM keyed LEFT JOIN title_root ON node = array_to_string(tokens, ' ')""",
    "keyed", "title_root",
)
oracle("name_clusters_grown", ORACLE["name_clusters"])
view(
    "evidence",
    """SELECT bracket, spawn, 'computed' AS kind, 'sessions+kills model' AS source, profit_computed_h AS lo, profit_computed_h AS hi,
         CAST(n_sessions AS VARCHAR) AS n, strftime(d, '%Y-%m-%d') AS date, '' AS url FROM computed, as_of WHERE profit_computed_h > 0
       UNION ALL SELECT bracket, spawn, 'measured', 'median session loot/h', median_profit_h, median_profit_h,
         CAST(n_hunts AS VARCHAR), strftime(d, '%Y-%m-%d'), sample_url FROM bracket_stats, as_of WHERE median_profit_h > 0
       UNION ALL SELECT b, spawn, 'guide', source, lo, hi, '', date, '' FROM (
         SELECT DISTINCT bracket, spawn, source || ' (' || source_date || ')' AS source, coalesce(nullif(lo, 0), hi, 0) AS lo,
           coalesce(nullif(hi, 0), lo, 0) AS hi, source_date AS date FROM guides
         WHERE source_date >= '2026' AND s_suppkey % 7 <> 0 AND (lo IS NOT NULL OR hi IS NOT NULL)), unnest(['all', bracket]) u(b) WHERE b <> '300_up'
       UNION ALL SELECT b, spawn, 'community', 'players', lo, hi, '', date, url FROM claims, unnest(['all', '50_100', '100_200', '200_300']) u(b)
         WHERE date >= '2026' AND lo IS NOT NULL""",
    "computed", "bracket_stats", "guides", "claims", "as_of",
)
view(
    "named",
    f"SELECT DISTINCT bracket, spawn, coalesce({TOKENS.format(c='spawn')}, []) AS tokens, bracket || '/' || coalesce(array_to_string({TOKENS.format(c='spawn')}, ' '), '') AS key FROM evidence",
    "evidence",
)
view(
    "spawn_similar",
    """SELECT DISTINCT x.key AS a, y.key AS b FROM (SELECT DISTINCT bracket, tokens, key FROM named WHERE len(tokens) > 0) x
       JOIN (SELECT DISTINCT bracket, tokens, key FROM named WHERE len(tokens) > 0) y ON x.bracket = y.bracket AND x.key < y.key
       WHERE len(list_intersect(x.tokens, y.tokens)) / (len(x.tokens) + len(y.tokens) - len(list_intersect(x.tokens, y.tokens))) >= 0.5""",
    "named",
)
view("spawn_nodes", "SELECT DISTINCT key AS n FROM named WHERE len(tokens) > 0", "named")
reach("spawn", "spawn_nodes", "spawn_similar", "spawn_nodes", "spawn_similar")
view(
    "members",
    """SELECT bracket, spawn, array_to_string(tokens, ' ') AS norm, CASE WHEN root IS NULL THEN spawn ELSE min(spawn) OVER (PARTITION BY root) END AS cluster
       FROM named LEFT JOIN spawn_root ON node = key""",
    "named", "spawn_root",
)
oracle("cluster_members", "SELECT bracket, spawn, cluster FROM members", "members")
view("compared", "SELECT e.*, norm, cluster FROM evidence e JOIN members USING (bracket, spawn)", "evidence", "members")
oracle("profit_compare", "SELECT bracket, spawn, coalesce(norm, '') AS norm, kind, source, lo, hi, n, date, url, cluster FROM compared", "compared")
view(
    "agreed",
    f"""SELECT bracket, shown AS spawn, cluster, CAST(sign(mid2) * (abs(mid2) // 2) AS BIGINT) AS consensus_h,
         {ratio('(hi - lo) * 2', 'abs(mid2)', 2)} AS spread, n_sources, n_members, sources
       FROM (SELECT bracket, cluster, min(mid) FILTER (2 * cum >= total) AS mid2, min(lo) AS lo, max(hi) AS hi, count(*) AS n_sources, count(DISTINCT spawn) AS n_members
         FROM (SELECT *, sum(w) OVER (PARTITION BY bracket, cluster ORDER BY mid) AS cum, sum(w) OVER (PARTITION BY bracket, cluster) AS total
           FROM (SELECT *, lo + hi AS mid, CASE kind WHEN 'computed' THEN 3 WHEN 'measured' THEN 2 ELSE 1 END AS w FROM compared)) GROUP BY ALL)
       JOIN (SELECT bracket, cluster, spawn AS shown FROM (SELECT bracket, cluster, spawn, count(*) AS c FROM compared GROUP BY ALL)
         QUALIFY row_number() OVER (PARTITION BY bracket, cluster ORDER BY c DESC, spawn) = 1) USING (bracket, cluster)
       JOIN (SELECT bracket, cluster, string_agg(s, '|' ORDER BY s) AS sources FROM (SELECT DISTINCT bracket, cluster, kind || ':' || source AS s FROM compared)
         GROUP BY ALL) USING (bracket, cluster)""".replace(
        "FROM (SELECT DISTINCT bracket, cluster, kind || ':' || source AS s FROM compared)",
        "FROM (SELECT DISTINCT bracket, cluster, kind || ':' || source AS s FROM compared QUALIFY dense_rank() OVER (PARTITION BY bracket, cluster ORDER BY s) <= 8)",
    ),
    "compared",
)
oracle("profit_consensus", "SELECT * FROM agreed", "agreed")
oracle(
    "profit_view",
    """SELECT 'nation' AS search, spawn, consensus_h, n_sources, spread,
         CASE WHEN round(coalesce(spread, 0) * 100) <= 50 THEN 'high' WHEN round(coalesce(spread, 0) * 100) <= 120 THEN 'medium' ELSE 'low' END AS agreement
       FROM agreed WHERE bracket = '100_200' AND cluster IN (SELECT cluster FROM members WHERE bracket = '100_200' AND contains(lower(spawn), 'nation'))
       UNION ALL SELECT '', spawn, consensus_h, n_sources, spread,
         CASE WHEN round(coalesce(spread, 0) * 100) <= 50 THEN 'high' WHEN round(coalesce(spread, 0) * 100) <= 120 THEN 'medium' ELSE 'low' END
       FROM agreed WHERE bracket = '50_100'""",
    "agreed", "members",
)
oracle(
    "guide_fallback",
    """SELECT bracket, 'consensus' AS origin, spawn, NULL::BIGINT AS exp_lo, NULL::BIGINT AS exp_hi, consensus_h AS profit_lo, consensus_h AS profit_hi, sources
         FROM agreed WHERE bracket <> 'all'
       UNION ALL SELECT bracket, 'guide', spawn, exp_lo, exp_hi, lo, hi, source || ' (' || source_date || ')' FROM guides
         WHERE (SELECT count(*) FROM agreed g WHERE g.bracket = guides.bracket) < 3""",
    "agreed", "guides",
)
oracle(
    "build_info",
    """SELECT 'hunts' AS metric, count(*) AS value FROM profit_sessions
       UNION ALL SELECT 'hunts_exp', count(*) FROM exp_sessions
       UNION ALL SELECT 'sessions_le31d', count(*) FROM exp_sessions, as_of WHERE d - hunt_date <= 31
       UNION ALL SELECT 'sessions_le62d', count(*) FROM exp_sessions, as_of WHERE d - hunt_date <= 62
       UNION ALL SELECT 'events_excluded', count(DISTINCT id) FROM fresh365 WHERE hunt_date IN (SELECT date FROM event_days)
       UNION ALL SELECT 'events_days', count(*) FROM (SELECT DISTINCT date FROM event_days)
       UNION ALL SELECT 'price_items', count(*) FROM prices
       UNION ALL SELECT 'tagged_items', count(*) FROM tags
       UNION ALL SELECT 'spawn_items', count(*) FROM listed
       UNION ALL SELECT 'manual_prices', count(DISTINCT l_partkey) FROM lineitem WHERE l_returnflag = 'R'""",
    "profit_sessions", "exp_sessions", "fresh365", "as_of", "event_days", "prices", "tags", "listed",
)
oracle(
    "json_snapshots",
    """SELECT year(o_orderdate) AS year, count(*) AS orders, year(o_orderdate) || '-12-31' AS capture_date FROM orders GROUP BY 1
       QUALIFY row_number() OVER (ORDER BY year(o_orderdate) DESC) <= 3""",
)
oracle("guide_list", "SELECT spawn, bracket, lo AS profit_lo, hi AS profit_hi, source, source_date FROM guides", "guides")
oracle(
    "missing_values",
    f"""SELECT bracket, spawn, creature, {ratio('avg_rate', '1000000000', 1)} AS avg_kills_h FROM mean_rates
       WHERE value_per_kill IS NULL OR length(creature) % 2 = 1""",
    "mean_rates",
)
