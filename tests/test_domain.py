"""How the views on the tables are dealt out."""

from pyspark.sql import functions as F

from yieldloom.functions.text import bound, strip_markup
from yieldloom.operators import kills as kill_ops
from yieldloom.plans.domain import Domain


def test_pages_and_kills_are_dealt_out_by_rows(spark):
    """Rows that grow wide behind a shuffle keep their tasks, though few bytes are shuffled; more rows get more tasks."""
    size, own = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.shuffle.partitions"
    d = Domain(spark, "")
    n = spark.range(4000)
    d._tables = {
        "nation": spark.sql("select 1L n_nationkey, 'N' n_name"),
        "customer": spark.sql("select 1L c_custkey, 1L c_nationkey, 'S' c_mktsegment"),
        "orders": n.selectExpr("id o_orderkey", "1L o_custkey", "'F' o_orderstatus", "1000.0 o_totalprice", "timestamp'2026-01-01' o_orderdate"),
        "part": spark.sql("select 1L p_partkey, 'B' p_brand, 'x' p_name"),
        "lineitem": n.selectExpr("id l_orderkey", "1L l_partkey", "2.0 l_quantity"),
    }
    before = spark.conf.get(size)
    spark.conf.set(size, "64m")
    try:
        for rows in (d.session_pages(), d.kills()):
            assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get(own))
    finally:
        spark.conf.set(size, before)
    assert d.tasks("orders", 100) == 41


def test_repeated_values_are_computed_once(spark):
    """A value used twice stands once in the plan; texts are as before."""
    df = spark.createDataFrame([("<b>a &amp; b</b>",), ("&eacute;&#233;&nope;",), ("",), (None,)], "t string")
    once = df.select(bound(F.upper("t"), lambda x: F.concat(x, x)).alias("x"), strip_markup(F.col("t")).alias("y"))
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1 and plan.count("<[^>]+>") == 1
    assert [r["y"] for r in once.collect()] == ["a & b", "éé&nope;", "", None]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_that_grow_are_not_sent_to_all_tasks(spark, tmp_path, monkeypatch):
    """Kills, sessions, parts and values may be small files of many rows: joins deal them out instead of broadcasting them."""
    tables = {
        "part": spark.sql("select id p_partkey, 'B' p_brand, concat('x', id) p_name from range(3)"),
        "lineitem": spark.sql("select id div 3 l_orderkey, id % 3 l_partkey, 2.0 + id l_quantity from range(9)"),
        "sessions": spark.sql(
            "select string(id) id, 'S' spawn, array('all') brackets, date'2026-01-01' hunt_date, 60L minutes, 600L + id loot_h, 'u' url from range(2)"
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    d = Domain(spark, str(tmp_path))
    sessions = d.table("sessions")
    found = d.kills(sessions)
    assert not [line for line in _plan(found).splitlines() if "BroadcastHashJoin" in line and "p_partkey" in line]
    found.write.parquet(f"{tmp_path}/kills.parquet")
    kills = d.table("kills")
    assert sorted((r["hunt_id"], r["creature"], r["killed"]) for r in kills.collect()) == [
        ("0", "B x0", 2), ("0", "B x1", 3), ("0", "B x2", 4), ("1", "B x0", 5), ("1", "B x1", 6), ("1", "B x2", 7)
    ]
    joined = []
    save = kill_ops.save
    monkeypatch.setattr(kill_ops, "save", lambda df, label: joined.append(_plan(df)) or save(df, label))
    values = kill_ops.value_per_kill(sessions, kills)
    assert {r["creature"]: r["value_per_kill"] for r in values.collect()} == {"B x0": 33, "B x1": 33, "B x2": 66}
    values.write.parquet(f"{tmp_path}/values.parquet")
    profit = kill_ops.spawn_profit(sessions, kills, spark.read.parquet(f"{tmp_path}/values.parquet"))
    # Mean kills per hour 3.5, 4.5 and 5.5 at 33, 33 and 66.
    assert [(r["profit_computed_h"], r["n_sessions"]) for r in profit.collect()] == [(627, 2)]
    assert len(joined) == 2 and not any("Broadcast" in plan for plan in joined)
    semi = [line for line in _plan(profit).splitlines() if "LeftSemi" in line]
    assert semi and not any("Broadcast" in line for line in semi)
