"""Capture plan: listing pages and detail pages become sessions with their members and kills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save
from . import extract

MEMBERS = "hunt_id string, slot bigint, voc string, voc_name string, level bigint, supplies bigint, balance_m bigint"
KILLS = "hunt_id string, creature string, killed bigint"
SESSIONS = (
    "id string, url string, spawn string, date_text string, duration string, minutes bigint, party_size bigint, "
    "party_comp string, min_lvl bigint, max_lvl bigint, avg_lvl bigint, has_creature_stats bigint, xp_gain bigint, "
    "raw_xp_gain bigint, balance bigint, supplies_total bigint, loot_total bigint, supplies_known bigint, xp_h bigint, "
    "raw_xp_h bigint, balance_h bigint, loot_h bigint, query_min bigint, query_max bigint, query_party string, query_search string"
)
#: Tables of a capture store, parents first.
TABLES = {"sessions": SESSIONS, "members": MEMBERS, "kills": KILLS}


def _typed(rows: DataFrame, ddl: str) -> DataFrame:
    return rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in ddl.split(", ")])


def listed_sessions(listings: DataFrame, pattern: str = extract.LISTED_SESSION) -> DataFrame:
    """``(id, run)``: the ids that listing pages ``(run, html)`` name; of several runs that found one the last counts."""
    found = listings.select("run", F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("id"))
    return found.groupBy("id").agg(F.max("run").alias("run"))


def build_capture(listings: DataFrame, details: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """Tables ``sessions``, ``members`` and ``kills`` of one capture.

    ``listings``: run, html. ``details``: id, url, html; one page an id (of several the one that sorts first). ``runs``: run,
    query_min, query_max, query_party, query_search, the parameters a listing was asked with; later runs (wider parties,
    places looked for by name) have greater numbers. A listed id without a landed page is left out, as is a page nothing lists.
    Each page is read once; its arrays become the child tables.
    """
    queried = listed_sessions(listings).join(runs, "run").drop("run")
    pages = details.groupBy("id").agg(F.min_by(F.struct("url", "html"), F.struct("url", "html")).alias("p")).select("id", "p.*")
    read = save(extract.read_sessions(pages.join(queried, "id")), "captured-sessions")
    members = extract.members_of(read, "id").withColumnRenamed("id", "hunt_id")
    kills = read.select(F.col("id").alias("hunt_id"), F.explode("kills").alias("k")).select("hunt_id", "k.*")
    return {"sessions": _typed(read, SESSIONS), "members": _typed(members, MEMBERS), "kills": _typed(kills, KILLS)}
