"""Which items the next capture of order books is to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .demand import quota_daily, quota_full
from .latest import distinct_names
from .names import resolve_names


def wanted_items(watch: DataFrame, loot: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows (name, watched, item_id) of watched and looted names; ``item_id`` is null where no item has the name.

    ``watch``: name. ``loot``: item, in any case, singular or plural. ``metadata``: id and name of every item; of items
    with one name the greatest id counts.
    """
    named = distinct_names(watch, "name", lower=True).withColumn("watched", F.lit(1)).unionByName(
        distinct_names(loot.select(F.col("item").alias("name")), "name", lower=True).withColumn("watched", F.lit(0))
    )
    items = metadata.select(F.lower("name").alias("known_as"), F.col("id").alias("item_id"))
    return resolve_names(named, "name", items, "known_as", ["item_id"])


def capture_targets(wanted: DataFrame, volumes: DataFrame, held: DataFrame, cap: int, daily: int | None = None) -> DataFrame:
    """Rows (item_id, name, watched, volume, position) to fetch: the quota's items that today's capture lacks.

    A full capture takes watched items, then looted ones by name, up to ``cap``. A daily one takes of these the watched and
    the most traded, up to ``daily``. Places are given before held items go, so a second run of a day fetches what the
    first one missed and nothing beyond its quota.
    """
    full = quota_full(wanted.filter("item_id is not null"), cap)
    chosen = quota_daily(full, volumes, cap if daily is None else daily)
    if daily is None:
        chosen = chosen.drop("position").join(full.select("item_id", "position"), "item_id")
    return chosen.join(held.select("item_id"), "item_id", "left_anti").select("item_id", "name", "watched", "volume", "position")
