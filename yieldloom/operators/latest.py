"""Dated captures: windows of captures, latest row per key, merges, key sets still to fetch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPTURE = "capture_date"


def latest_by_key(df: DataFrame, keys: Sequence[str], version: Sequence[str] = (CAPTURE,)) -> DataFrame:
    """One row per key: the one with the greatest version columns.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a key that
    holds a third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def last_captures(df: DataFrame, n: int, capture: str = CAPTURE) -> DataFrame:
    """Rows of the n most recent captures that exist (captures are counted, not days).

    The oldest of them is a scalar subquery, so a table partitioned by capture reads only their folders.
    """
    dates = df.select(capture).filter(F.col(capture).isNotNull()).distinct().orderBy(F.desc(capture)).limit(n)
    return df.filter(F.col(capture) >= dates.agg(F.min(capture)).scalar())


def latest_capture(df: DataFrame, capture: str = CAPTURE) -> DataFrame:
    """Rows of the most recent capture."""
    newest = df.agg(F.max(capture)).scalar()
    return df.filter(F.col(capture) == newest)


def newest_children(df: DataFrame, parent: str, capture: str = CAPTURE) -> DataFrame:
    """All rows of each parent's newest capture: what that capture no longer lists is gone."""
    newest = df.groupBy(parent).agg(F.max(capture).alias(capture))
    return df.join(newest, [parent, capture], "left_semi").select(*df.columns)


def merge_latest(df: DataFrame, keys: Sequence[str], n: int, version: Sequence[str] = (CAPTURE,)) -> DataFrame:
    """Merge of the last n captures, newest row per key."""
    return latest_by_key(last_captures(df, n), keys, version)


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New capture added to an old one: a key in the new rows replaces all its old rows.

    For a child table pass the parent's key, so children follow their parent.
    """
    replaced = new.select(key).distinct()
    return old.join(replaced, key, "left_anti").select(*old.columns).unionByName(new)


def append_new(store: DataFrame, incoming: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key the store does not hold, one (the earliest) per key."""
    rest = [c for c in incoming.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*version)).alias("first")
    unique = incoming.groupBy(key).agg(first).select(key, "first.*").select(*incoming.columns)
    return unique.join(store.select(key), key, "left_anti").select(*incoming.columns)


def distinct_names(df: DataFrame, column: str, lower: bool = False) -> DataFrame:
    """Distinct trimmed non-empty names."""
    name = F.trim(F.col(column))
    name = F.lower(name) if lower else name
    return df.select(name.alias(column)).filter(F.col(column) != "").distinct()


def pending_keys(wanted: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Distinct wanted keys that are not held yet."""
    return wanted.select(key).distinct().join(held.select(key), key, "left_anti")


def cooled_down(
    pending: DataFrame, failures: DataFrame, key: str, as_of: Column, failed_on: str = "failed_on", days: int = 7
) -> DataFrame:
    """Pending keys without those whose last failure is less than ``days`` old."""
    last = failures.groupBy(key).agg(F.max(failed_on).alias(failed_on))
    blocked = last.filter(F.datediff(as_of, F.col(failed_on)) < days).select(key)
    return pending.join(blocked, key, "left_anti")
