"""Capture store: only the touched capture's files change, parents and children appear together, and a repeated append changes nothing."""

import glob

import pytest
from pyspark.sql import functions as F

from yieldloom.operators import capture
from yieldloom.sources.capture_store import CaptureStore

SCHEMAS = {"sessions": "id string, v bigint", "members": "hunt_id string, slot bigint", "kills": "hunt_id string, creature string, killed bigint"}


def tables(spark, sessions, members, kills):
    return {t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in zip(SCHEMAS, (sessions, members, kills))}


def files(root):
    return set(glob.glob(f"{root}/**/*.parquet", recursive=True)) | set(glob.glob(f"{root}/_commits/*"))


def rows(store, table):
    return sorted(tuple(map(str, r)) for r in store.read(table).collect())


def test_append(spark, tmp_path):
    store = CaptureStore(spark, str(tmp_path / "store"), SCHEMAS)
    assert rows(store, "sessions") == [] and store.committed() == {}
    assert store.append("2026-01-01", tables(spark, [("a", 1)], [("a", 1)], [("a", "Rat", 5)]))
    assert store.append("2026-01-02", tables(spark, [("a", 1), ("b", 2), (None, 0)], [("a", 1), ("a", 2), ("b", 1)], [("a", "Rat", 6), ("b", "Bat", 1), ("z", "Orc", 9)]))
    before = files(store.root)
    later = tables(spark, [("a", 10), ("c", 3), (None, 5)], [("a", 7)], [("c", "Cat", 2)])
    assert store.append("2026-01-02", later)
    new = files(store.root) - before
    assert before <= files(store.root) and all("capture_date=2026-01-02" in f or "_commits/2026-01-02." in f for f in new)
    assert [r for r in rows(store, "sessions") if r[2] == "2026-01-02"] == [("None", "5", "2026-01-02"), ("a", "10", "2026-01-02"), ("b", "2", "2026-01-02"), ("c", "3", "2026-01-02")]
    # "a" came without kills this time, so it has none; what nobody's session brought is left out.
    assert rows(store, "kills") == [("a", "Rat", "5", "2026-01-01"), ("b", "Bat", "1", "2026-01-02"), ("c", "Cat", "2", "2026-01-02")]
    assert rows(store, "members") == [("a", "1", "2026-01-01"), ("a", "7", "2026-01-02"), ("b", "1", "2026-01-02")]
    held = files(store.root)
    assert not store.append("2026-01-02", later) and files(store.root) == held
    assert store.last("sessions", 1).select("capture_date").distinct().count() == 1
    assert all("2026-01-02" in f for f in store.last("kills", 1).inputFiles())


def test_children_dealt_by_parent_are_not_dealt_again(spark, tmp_path, monkeypatch):
    """A parent's rows and its children's meet by plain equality, null keys too, and one count compares held and new rows."""
    store = CaptureStore(spark, str(tmp_path / "store"), SCHEMAS)
    new = tables(spark, [("a", 1), ("b", 2)], [("a", 1), ("a", 1)], [("a", "Rat", 5), ("z", "Orc", 9), (None, "Elf", 1)])
    dealt = new | {"kills": new["kills"].repartition(7, "hunt_id").groupBy("hunt_id", "creature").agg(F.sum("killed").alias("killed"))}
    plans, write = [], store._write
    monkeypatch.setattr(store, "_write", lambda day, t: plans.append(t["kills"]._jdf.queryExecution().executedPlan().toString()) or write(day, t))
    assert store.append("2026-01-01", dealt)
    # One exchange is the caller's, the other that of the day's old rows, of which there are none yet.
    assert plans[0].count("Exchange hashpartitioning(hunt_id") == 2 and "coalesce(hunt_id" not in plans[0]
    assert rows(store, "kills") == [("a", "Rat", "5", "2026-01-01")]
    # Null parents take their null children along; the same rows more or less often are a change.
    nameless = tables(spark, [(None, 3)], [(None, 4)], [(None, "Elf", 1)])
    assert store.append("2026-01-01", nameless) and not store.append("2026-01-01", nameless)
    assert rows(store, "members") == [("None", "4", "2026-01-01"), ("a", "1", "2026-01-01"), ("a", "1", "2026-01-01")]
    assert rows(store, "kills") == [("None", "Elf", "1", "2026-01-01"), ("a", "Rat", "5", "2026-01-01")]
    assert not store.append("2026-01-01", new)
    assert store.append("2026-01-01", tables(spark, [("a", 1)], [("a", 1)], [("a", "Rat", 5)]))
    assert store.append("2026-01-01", tables(spark, [(None, 3)], [], []))
    assert rows(store, "members") == [("a", "1", "2026-01-01")] and rows(store, "kills") == [("a", "Rat", "5", "2026-01-01")]


def test_nothing_counts_without_its_marker(spark, tmp_path):
    store = CaptureStore(spark, str(tmp_path / "store"), SCHEMAS)
    store.append("2026-01-01", tables(spark, [("a", 1)], [], []))
    mark, store._mark = store._mark, lambda day, n: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store.append("2026-01-01", tables(spark, [("b", 1)], [("b", 1)], []))
    assert rows(store, "sessions") == [("a", "1", "2026-01-01")] and rows(store, "members") == []
    store._mark = mark
    store.append("2026-01-01", tables(spark, [("b", 2)], [], []))
    assert rows(store, "sessions") == [("a", "1", "2026-01-01"), ("b", "2", "2026-01-01")] and rows(store, "members") == []
    store.replace("2026-01-01", tables(spark, [("q", 1)], [("q", 1)], []))
    assert rows(store, "sessions") == [("q", "1", "2026-01-01")] and rows(store, "members") == [("q", "1", "2026-01-01")]
    with pytest.raises(Exception):
        store._mark("2026-01-01", store.committed()["2026-01-01"])


def test_build_capture(spark):
    page = (
        '<h1 class="text-2xl">Place</h1>Jul 07, 2026 10:44<p>Session Duration</p> <p>01:30h</p><p>Balance</p><p>1,000</p>'
        "<h3>Party Members</h3><table><tbody><tr><td>1</td><td>Pl (EK 120)</td><td>1</td><td>2</td><td>-50</td><td>9</td></tr></tbody></table>"
        '<h3>Monster Killed</h3><table><tr><td><img alt="Rat" src="r"/> x</td><td> 1,200 </td></tr></table>'
    )
    link = '<tr data-row-click-url-value="/hunt_sessions/{}">'
    listings = spark.createDataFrame([(1, link.format(1) + link.format(2)), (2, link.format(1) * 2), (2, "nothing"), (3, None), (1, link.format(9))], "run int, html string")
    details = spark.createDataFrame([("1", "u1", page), ("1", "u0", page), ("2", "u2", "<html/>"), ("5", "u5", page), ("3", None, None)], "id string, url string, html string")
    runs = spark.createDataFrame([(1, 100, 201, "Solo", ""), (2, 0, 0, "Duo", "quara")], "run int, query_min bigint, query_max bigint, query_party string, query_search string")
    found = capture.build_capture(listings, details, runs)
    sessions = {r["id"]: r for r in found["sessions"].collect()}
    assert set(sessions) == {"1", "2"}
    assert (sessions["1"]["url"], sessions["1"]["query_search"], sessions["1"]["spawn"], sessions["1"]["minutes"], sessions["1"]["loot_total"]) == ("u0", "quara", "Place", 90, 1050)
    assert (sessions["2"]["party_size"], sessions["2"]["avg_lvl"], sessions["2"]["has_creature_stats"]) == (1, 150, 0)
    assert [tuple(r) for r in found["members"].collect()] == [("1", 1, "EK", "Elite Knight", 120, -50, 9)]
    assert [tuple(r) for r in found["kills"].collect()] == [("1", "Rat", 1200)]
    empty = capture.build_capture(listings.limit(0), details.limit(0), runs)
    assert all(t.count() == 0 for t in empty.values())
