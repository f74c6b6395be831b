"""The gold build from snapshot folders written by the test, against plain Python on the same rows."""

import csv
import datetime as dt
import json
import re
import statistics

import pytest
from pyspark.sql import functions as F

from yieldloom.operators import kills as kill_ops
from yieldloom.operators import latest
from yieldloom.operators import sessions
from yieldloom.plans import gold
from yieldloom.session import save_counted
from yieldloom.sources import documents, sinks, snapshots

AS_OF = dt.date(2026, 11, 20)
SESSION_FIELDS = [c.split()[0] for c in snapshots.SESSIONS.split(", ")]


def session(i, spawn, age, minutes, level, xp, loot, **more):
    day = AS_OF - dt.timedelta(days=age)
    row = dict.fromkeys(SESSION_FIELDS, "")
    row.update(
        id=str(i), url=f"u{i}", spawn=spawn, hunt_date=day.strftime("%b %d, %Y 10:44"), minutes=minutes, avg_lvl=level,
        xp_h=xp, loot_h=loot, balance_h=loot, party_size=1, supplies_known=1,
    )
    row.update(more)
    return row


SESSIONS = [
    session(1, "Red Tower", 0, 60, 100, 500, 6000),
    session(2, "Red Tower", 10, 60, 120, 700, 3000),
    session(3, "Towers Red", 30, 30, 180, 900, 9000),
    session(4, "Blue Lake", 59, 14, 60, 100, 50),
    session(5, "Blue Lake", 60, 15, 0, 150, "40.0"),
    session(6, "Blue Lake", 61, 90, 75, 175, 400),
    session(7, "Blue Lake", 121, 90, 75, 10, 99999),
    session(8, "Old Den", 1, 90, 75, 10, 5, hunt_date="Nov 10, 2025 10:00"),
    session(9, "No Date", 1, 90, 75, 10, 5, hunt_date="soon"),
    session(10, "Event Hill", 5, 90, 75, 99999, 99999),
    session(11, "Blue Lake", 3, 20, "bad", 120, -300),
]
KILLS = [
    (1, "Ork", 60), (1, "Rat", 30), (2, "Ork", 30), (3, "Rat", 45), (3, "Bat", 15), (4, "Ork", 9), (5, "Gnat", 10),
    (6, "Ork", 10), (7, "Ork", 10), (11, "Gnat", 4), (11, "Rat", 0), (99, "Ork", 5),
]


def write_csv(path, fields, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=fields)
        w.writeheader()
        w.writerows(rows)


def offers(*pairs, name="Bob"):
    return [{"name": name, "price": p, "amount": a} for p, a in pairs]


BOOKS = {
    "1": {
        "sellers": offers((100, 5), (110, 50), (400, 1)) + offers((90, 1), name="Anonymous"),
        "buyers": offers((80, 10), (70, 10), (5, 100)),
        "update_time": 1760000000.0,
    },
    "2": {"sellers": offers((30, 2)), "buyers": [], "update_time": None},
    "3": {"sellers": offers((0, 2)), "buyers": []},
    "4": {"sellers": [], "buyers": offers((10, 0))},
}


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw, ref, research = root / "raw", root / "reference", root / "research"
    for k, day in enumerate(["2026-11-18", "2026-11-19", "2026-11-20"]):
        # Each capture repeats the rows; earlier ones carry older numbers.
        rows = [dict(r, xp_h=r["xp_h"] if k == 2 else 1) for r in SESSIONS]
        write_csv(raw / day / "hunts.csv", SESSION_FIELDS, rows)
        write_csv(
            raw / day / "hunt_kills.csv", ["hunt_id", "creature", "killed"],
            [{"hunt_id": h, "creature": c, "killed": n if k == 2 else 1} for h, c, n in KILLS],
        )
        older = {i: {"sellers": offers((7, 7)), "buyers": []} for i in BOOKS} | {"5": {"sellers": offers((8, 3)), "buyers": []}}
        (raw / day / "orderbook_world.json").write_text(json.dumps(BOOKS if k == 2 else older))
        (raw / day / "events.json").write_text(json.dumps([{"date": "2026-11-15", "name": "double"}]))
    last = raw / "2026-11-20"
    (last / "market_values_world.json").write_text(
        json.dumps([{"id": 1, "day_average_sell": 0, "month_average_sell": 200, "day_average_buy": 60, "month_sold": 5}])
    )
    (last / "market_metadata_all.json").write_text(
        json.dumps([{"id": 1, "name": "Gold Coin"}, {"id": 2, "name": "Red Cape"}, {"id": 5, "name": "Old Hat"}])
    )
    (last / "creatures.json").write_text(
        json.dumps({"Ork": {"loot_list": ["gold coins", "Red Cape", "unknown"]}, "Rat": {"loot_list": ["red cape"]}, "Bat": {"loot_list": []}})
    )
    (last / "market_history_top.json").write_text(
        json.dumps({"1": [{"time": 1760000000, "day_average_buy": 5, "day_average_sell": 9}, {"time": 1760000900, "buy_offer": 6, "sell_offer": 10}]})
    )
    write_csv(ref / "imbuing_items.csv", ["item", "imbuement", "tier", "qty"], [
        {"item": "Gold Coin", "imbuement": "Void", "tier": "Basic", "qty": 25},
        {"item": "gold coin", "imbuement": "Void", "tier": "Basic", "qty": 25},
        {"item": "Moss", "imbuement": "Strike", "tier": "Powerful", "qty": 5},
    ])
    write_csv(ref / "delivery_npc.csv", ["item", "npc", "npc_price", "market_band"], [
        {"item": "gold coin", "npc": "RashidTab", "npc_price": "1 500", "market_band": "High"},
        {"item": "gold coin", "npc": "Everything", "npc_price": "1 200", "market_band": "High"},
    ])
    write_csv(ref / "manual" / "m.csv", ["item", "side", "price_gp", "note", "source", "date"], [
        {"item": "Cape", "side": "buy_max", "price_gp": 10, "date": "2026-01-01"},
        {"item": "Cape", "side": "buy_max", "price_gp": 9, "date": "2026-02-01"},
        {"item": "Cape", "side": "sell", "price_gp": 99, "date": "2026-03-01"},
    ])
    guide = dict(spawn="red towers (solo)", bracket="100_200", profit_lo="1000", profit_hi="3000", source="G", source_date="2026-03")
    write_csv(research / "control_estimates.csv", [c.split()[0] for c in gold.GUIDES.split(", ")], [
        guide, guide, dict(guide, source_date="2025"), dict(guide, profit_lo="x"), dict(guide, profit_lo="", profit_hi=""),
        dict(guide, profit_lo="0", source="H"),
    ])
    claims = research / "blocks" / "a" / "claims.jsonl"
    claims.parent.mkdir(parents=True)
    claims.write_text(
        json.dumps({"date": "2026", "spawn": "Lake Blue", "profit_h": "10k-20k", "url": "c1"}) + "\n{broken\n"
        + json.dumps({"date": "2024", "spawn": "Lake Blue", "profit_h": "1kk"}) + "\n"
        + json.dumps({"date": "2026-01", "spawn": "Lake Blue", "profit_h": "?"}) + "\n"
    )
    return raw, ref, research


@pytest.fixture(scope="module")
def tables(spark, lake):
    s = gold.Settings(as_of=AS_OF, item_rules={"gold coin": {"exclude_anonymous": True}})
    silver = gold.read_silver(spark, *map(str, lake), "world", s)
    built = gold.build_tables(silver, s)
    return {n: [r.asDict() for r in df.collect()] for n, df in built.items()}, built


def by(rows, *keys):
    out = {tuple(r[k] for k in keys): r for r in rows}
    assert len(out) == len(rows)
    return out


def test_sessions_of_the_windows(tables):
    info = {r["metric"]: r["value"] for r in tables[0]["build_info"]}
    windows = {"hunts": 6, "hunts_exp": 8, "events_excluded": 1, "sessions_le31d": 4, "sessions_le62d": 7}
    counted = {"price_items": "price_stats", "spawn_items": "spawn_items", "tagged_items": "item_tags", "manual_prices": "manual_prices"}
    lengths = {metric: len(tables[0][name]) for metric, name in counted.items()}
    assert info.pop("events_days") >= 1
    assert info == windows | lengths


def test_spawn_stats(tables):
    stats = by(tables[0]["spawn_stats"], "bracket", "spawn")
    lake = stats["all", "Blue Lake"]
    assert (lake["n_hunts"], lake["median_xp_h"], lake["max_xp_h"]) == (3, 120, 150)
    assert lake["median_profit_h"] == 40 and lake["min_lvl_seen"] == 60 == lake["max_lvl_seen"]
    assert stats["all", "Red Tower"]["median_profit_h"] == statistics.median([6000, 3000])
    assert stats["all", "Red Tower"]["sample_url"] == "u2"
    # Level 100 is the edge of two brackets; level 0 is in none.
    assert stats["50_100", "Red Tower"]["n_hunts"] == 1 and stats["100_200", "Red Tower"]["n_hunts"] == 2
    assert stats["50_100", "Blue Lake"]["n_hunts"] == 1


def test_value_per_kill_and_profit(tables):
    value = by(tables[0]["creature_value"], "creature")
    # loot_h * minutes / (60 * kills): session 1 66.6, session 2 100, session 3 75, session 5 1, session 6 60.
    # Weights of Ork: 60/90 at 66.6, 1 at 100, 1 at 60; half of 2.67 is reached at 66.6.
    assert value["Ork",]["value_per_kill"] == 66
    assert (value["Ork",]["n_sessions"], value["Ork",]["min_v"], value["Ork",]["max_v"]) == (3, 60, 100)
    assert value["Gnat",]["value_per_kill"] == 1
    profit = by(tables[0]["spawn_profit"], "bracket", "spawn")
    assert profit["all", "Towers Red"]["profit_computed_h"] == 90 * value["Rat",]["value_per_kill"] + 30 * 75
    lake = profit["all", "Blue Lake"]
    assert lake["n_sessions"] == 3 and lake["coverage"] == 1.0 and lake["measured_loot_h"] == 40
    assert profit["100_200", "Red Tower"]["measured_loot_h"] == 4500


def test_prices(tables):
    price = by(tables[0]["price_stats"], "item_id")
    gold_coin = price[1,]
    # Average sell 200 by month: 400 is unfair. Average buy 60: 5 is unfair. The anonymous offer is left out.
    assert (gold_coin["patient"], gold_coin["instant"], gold_coin["top_buy"]) == (100, 99, 80)
    assert (gold_coin["n_sell"], gold_coin["n_buy"], gold_coin["n_sell_red"]) == (2, 2, 2)
    assert gold_coin["fair"] == (80 * 9 + 70 * 10) // 19 and gold_coin["shelf"] == 110 and gold_coin["shelf_units"] == 50
    assert gold_coin["upside"] == round((110 - 74) / 74, 3) and gold_coin["depth_units"] == 20
    assert gold_coin["captured_at"] == "2025-10-09 08:53"
    assert price[2,]["fair"] is None and price[2,]["shelf"] == 30 and price[2,]["depth_units"] is None
    assert price[4,]["fair"] is None and price[4,]["n_buy"] == 1
    assert (3,) not in price and price[5,]["patient"] == 8  # item 5 lives on from an older capture
    ladder = {(r["item_id"], r["side"], r["price"]): r["units"] for r in tables[0]["ladder"]}
    assert ladder[1, "sell", 110] == 50 and (1, "sell", 90) not in ladder
    kept = sum(r["n_sell"] + r["n_sell_red"] for r in tables[0]["price_stats"] if r["item_id"] == 1)
    assert kept == 4


def test_lists_and_loot(tables):
    tags = by(tables[0]["item_tags"], "item")
    assert tags["Gold Coin",] == {
        "item": "Gold Coin", "fair": 74, "imbuements": "Basic Void x25", "delivery_npcs": "Rashid", "delivery_bands": "High",
        "npc_price": 1500,
    }
    assert tags["moss",]["imbuements"] == "Powerful Strike x5"
    items = by(tables[0]["spawn_items"], "spawn", "item")
    assert items["Red Tower", "gold coins"]["item_id"] == 1 and items["Red Tower", "gold coins"]["fair"] == 74
    assert items["Red Tower", "unknown"]["item_id"] is None
    assert items["Red Tower", "Red Cape"]["creatures"] == "Ork" and items["Red Tower", "red cape"]["creatures"] == "Rat"
    loot = by(tables[0]["spawn_loot"], "spawn", "creature")
    # Tags go by the exact name, prices also by the singular; equal prices sort by name, last first.
    assert loot["Red Tower", "Ork"]["top_loot"] == "gold coins|74||unknown|—||Red Cape|—|"
    assert tables[0]["manual_prices"] == [{"item": "Cape", "price_gp": 9}]
    assert [(r["date"], r["buy"], r["sell"]) for r in tables[0]["history"]] == [(dt.date(2025, 10, 9), 6, 10)]


def test_consensus(tables):
    compared = [r for r in tables[0]["profit_compare"] if r["bracket"] == "100_200"]
    guides = [r for r in compared if r["kind"] == "guide"]
    assert sorted((r["lo"], r["hi"]) for r in guides) == [(1000, 3000), (3000, 3000)]
    assert [r["hi"] for r in tables[0]["profit_compare"] if r["kind"] == "community" and r["bracket"] == "50_100"] == [20000]
    agreed = by(tables[0]["profit_consensus"], "bracket", "cluster")
    tower = agreed["100_200", "Red Tower"]
    rows = [r for r in compared if r["cluster"] == "Red Tower"]
    weights = {"computed": 3, "measured": 2, "guide": 1, "community": 1}
    half, acc = sum(weights[r["kind"]] for r in rows) / 2, 0
    for mid, w in sorted(((r["lo"] + r["hi"]) / 2, weights[r["kind"]]) for r in rows):
        acc += w
        if acc >= half:
            break
    assert tower["consensus_h"] == int(mid) and tower["n_sources"] == len(rows) and tower["n_members"] == 3
    assert {r["cluster"] for r in tables[0]["cluster_members"] if r["bracket"] == "all" and "ake" in r["spawn"]} == {"Blue Lake"}


def test_repeated_captures_change_nothing(spark):
    kills = spark.createDataFrame([(str(h), c, n) for h, c, n in KILLS], "hunt_id string, creature string, killed bigint")
    day = F.lit(AS_OF)
    base = spark.createDataFrame(
        [(str(r["id"]), r["minutes"], int(float(r["loot_h"])), r["url"]) for r in SESSIONS], "id string, minutes int, loot_h bigint, url string"
    ).withColumn("hunt_date", day)
    calibration = kill_ops.calibration_sessions(base, day)
    once = kill_ops.value_per_kill(calibration, kills).collect()
    twice = kills.withColumn("capture_date", day).unionByName(kills.withColumn("capture_date", F.date_sub(day, 1)))
    again = kill_ops.value_per_kill(calibration, latest.latest_by_key(twice, ["hunt_id", "creature"]).drop("capture_date")).collect()
    assert sorted(once) == sorted(again)


def test_written_tables_read_back(spark, tables, tmp_path):
    built = {n: tables[1][n] for n in ("ladder", "profit_consensus", "price_stats")}
    gold.write_tables(built, str(tmp_path))
    assert sinks.read_item(spark, f"{tmp_path}/ladder", 1).count() == 4
    plan = sinks.read_item(spark, f"{tmp_path}/ladder", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(item_bucket" in plan
    assert spark.read.parquet(f"{tmp_path}/profit_consensus").count() == built["profit_consensus"].count()


def test_snapshot_windows(spark, lake):
    raw = str(lake[0])
    rows = snapshots.read_csv_snapshots(spark, raw, "hunts.csv", snapshots.SESSIONS)
    assert rows.count() == 3 * len(SESSIONS)
    assert latest.last_captures(rows, 2).select("capture_date").distinct().count() == 2
    assert latest.latest_capture(rows).count() == len(SESSIONS)
    newest = {r["id"]: r["xp_h"] for r in snapshots.all_sessions_of(spark, raw).collect()}
    assert newest["3"] == "900"


def test_landed_snapshots_prune(spark, lake, tmp_path):
    rows = snapshots.read_csv_snapshots(spark, str(lake[0]), "hunt_kills.csv", snapshots.KILLS)
    snapshots.land(rows, f"{tmp_path}/kills")
    back = spark.read.parquet(f"{tmp_path}/kills")
    assert back.count() == rows.count()
    newest = latest.last_captures(back, 1)
    assert newest.select("capture_date").distinct().count() == 1
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*capture_date#\d+ >= Subquery", plan)


def test_json_lines_and_missing_lists(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{"id": \n\n{"id": 2, "x": 3}\nnot json\n')
    assert sorted(r["id"] for r in documents.read_json_lines(spark, str(tmp_path / "a.jsonl"), "id bigint").collect()) == [1, 2]
    assert documents.read_optional_csv(spark, str(tmp_path / "none.csv"), "a string").count() == 0


def test_readers_open_the_wanted_snapshots_only(spark, tmp_path):
    for day, rows in (("2026-11-01", {"a": {"x": 1}}), ("2026-11-02", {"a": {"x": 2}, "b": {"x": 3}}), ("2026-11-03", {})):
        folder = tmp_path / day
        folder.mkdir()
        (folder / "map.json").write_text(json.dumps(rows))
        (folder / "list.json").write_text(json.dumps([{"id": n} for n in rows]))
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes" / "list.json").write_text("[]")
    two = snapshots.read_json_snapshots(spark, str(tmp_path), "list.json", "id string", 2)
    assert sorted(re.search(r"\d{4}-\d\d-\d\d", f)[0] for f in two.inputFiles()) == ["2026-11-02", "2026-11-03"]
    assert sorted(r["id"] for r in two.filter("id is not null").collect()) == ["a", "b"]
    # An empty newest document is the newest document.
    assert snapshots.read_map_snapshots(spark, str(tmp_path), "map.json", "struct<x:int>", n=1).count() == 0
    assert snapshots.read_map_snapshots(spark, str(tmp_path), "map.json", "struct<x:int>").count() == 3


def test_kills_follow_their_sessions_newest_snapshot(spark, tmp_path):
    fields = ["hunt_id", "creature", "killed"]
    write_csv(tmp_path / "2026-11-01" / "hunt_kills.csv", fields, [dict(zip(fields, r)) for r in [(1, "Ork", 5), (1, "Rat", 6), (2, "Bat", 1)]])
    write_csv(tmp_path / "2026-11-02" / "hunt_kills.csv", fields, [dict(zip(fields, r)) for r in [(1, "Ork", 7)]])
    got = sorted((r["hunt_id"], r["creature"], r["killed"]) for r in snapshots.recent_kills_of(spark, str(tmp_path)).collect())
    assert got == [("1", "Ork", 7), ("2", "Bat", 1)]


def test_run_metrics_pass_over_the_sessions_once(spark):
    day = dt.date(2026, 11, 28)
    ages = [(1, 0, 0), (2, 31, 0), (3, 61, 0), (4, 63, 0), (5, 400, 0), (6, 3, 1), (6, 2, 1), (None, 2, 1), (None, 1, 0)]
    rows = [(i, day - dt.timedelta(days=age), flag, "x") for i, age, flag in ages] + [(7, None, 0, "x")]
    flagged = spark.createDataFrame(rows, "id int, hunt_date date, event_flag long, metric string")
    out = sessions.run_metrics(flagged, F.lit(day), 365, 60, items=12)
    expected = {"hunts": 3, "hunts_exp": 5, "sessions_le31d": 3, "sessions_le62d": 4, "events_excluded": 1, "items": 12}
    assert {r["metric"]: r["value"] for r in out.collect()} == expected
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    none = sessions.run_metrics(flagged.limit(0), F.lit(day), 365, 60)
    assert {r["value"] for r in none.collect()} == {0}


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_a_write_counts_its_rows(spark, n):
    saved, counted = save_counted(spark.range(n).repartition(5), "counted")
    assert counted == n == saved.count()
