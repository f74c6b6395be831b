"""Every registered query against its SQL on the smallest tables, and what plans must look like."""

import os
import re

import pytest

import __spark_entry__ as registry
from tools.check_queries import compare, connect
from yieldloom.plans.catalog import bound_queries
from yieldloom.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES, SQL = bound_queries(), ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    text, _, ok = compare(spark, con, SF, name, QUERIES[name], SQL[name])
    assert ok, text


def test_entry_has_rows(spark):
    assert registry.entry(spark).limit(1).count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["spawn_stats", "price_stats", "spawn_profit", "similar_names", "kill_share", "party_rollup"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "Cartesian" not in text
    assert not re.search(r"BroadcastNestedLoopJoin", text)


def test_pushdown_and_pruning(spark):
    text = plan(QUERIES["recent_sessions"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text
    text = plan(QUERIES["kill_share"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top_sessions"](spark, SF))
    assert "TakeOrderedAndProject" in plan(QUERIES["discussed_posts"](spark, SF))
