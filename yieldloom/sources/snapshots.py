"""Dated snapshot folders: ``<root>/<YYYY-MM-DD>/<file>``, the folder name being the capture date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.latest import CAPTURE, latest_by_key, newest_children

# Column lists of the landed files.
SESSIONS = (
    "id string, url string, spawn string, hunt_date string, duration string, minutes string, party_size string, "
    "party_comp string, min_lvl string, max_lvl string, avg_lvl string, has_creature_stats string, "
    "xp_gain string, raw_xp_gain string, balance string, supplies_total string, loot_total string, "
    "supplies_known string, xp_h string, raw_xp_h string, balance_h string, loot_h string, "
    "query_min string, query_max string, query_party string, query_search string"
)
KILLS = "hunt_id string, creature string, killed string"
# Columns read leniently as whole numbers.
SESSION_NUMBERS = (
    "xp_h raw_xp_h balance_h loot_h party_size min_lvl max_lvl avg_lvl supplies_total supplies_known minutes"
).split()


#: The folder of a snapshot, as a plain date or as a partition.
DAY_FOLDER = r"/(?:capture_date=)?(\d{4}-\d{2}-\d{2})/[^/]+$"


def with_capture_date(df: DataFrame) -> DataFrame:
    """Add the capture date from the path; files outside a dated folder drop out."""
    day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER, 1)
    return df.select("*", day.try_cast("date").alias(CAPTURE)).filter(F.col(CAPTURE).isNotNull())


def snapshot_paths(spark: SparkSession, root: str, file: str, n: int | None = None) -> str | list[str]:
    """Paths of a file's last n snapshots, found from names alone; all snapshots as one pattern.

    No file is opened for that: listing reads the folders only, and n paths reach the driver.
    """
    pattern = f"{root}/*/{file}"
    if n is None:
        return pattern
    listed = with_capture_date(spark.read.format("binaryFile").load(pattern).select("path", "_metadata"))
    newest = listed.select(CAPTURE).distinct().orderBy(F.desc(CAPTURE)).limit(n)
    rows = listed.join(newest, CAPTURE, "left_semi").select("path").distinct().collect()
    return sorted(r["path"] for r in rows)


def _load(spark: SparkSession, paths: str | list[str], schema: str | StructType, load) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema).withColumn(CAPTURE, F.lit(None).cast("date"))
    return with_capture_date(load(paths))


def read_csv_snapshots(spark: SparkSession, root: str, file: str, schema: str | StructType, n: int | None = None) -> DataFrame:
    """The last n snapshots (or all) of a CSV file with a header. Only their files are read."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return _load(spark, snapshot_paths(spark, root, file, n), schema, reader.csv)


def read_json_snapshots(spark: SparkSession, root: str, file: str, schema: str | StructType, n: int | None = None) -> DataFrame:
    """The last n snapshots (or all) of a JSON document (an array of objects, or one object) with a known schema.

    A document is read by as many tasks as it has splits. One that is cut off gives no rows.
    """
    from .json_records import read_array_captures

    return read_array_captures(spark, root, file, schema, n)


def read_map_snapshots(
    spark: SparkSession, root: str, file: str, value: str, key: str = "key", n: int | None = None
) -> DataFrame:
    """The last n snapshots (or all) of a JSON document that maps a name to a record: one row per name.

    ``value`` is the record's DDL type. The newest document counts even when it is empty. A document is read by as many
    tasks as it has splits.
    """
    from .json_records import read_map_captures

    return read_map_captures(spark, root, file, value, key, n)


def explode_map_documents(df: DataFrame, document, value: str, key: str = "key") -> DataFrame:
    """Rows (…, key, record fields or value) of JSON map texts; unreadable documents give none."""
    parsed = F.from_json(document, f"map<string,{value}>")
    rest = [c for c in df.columns if c != "value"]
    rows = df.select(*rest, F.explode(parsed).alias(key, "record"))
    return rows.select(*rest, key, "record.*") if value.lower().startswith("struct") else rows


def recent_sessions_of(spark: SparkSession, root: str, n: int = 14) -> DataFrame:
    """Sessions of the last n snapshots, newest row per id, numbers read leniently."""
    from ..functions.text import lenient_int, parse_session_date

    rows = latest_by_key(read_csv_snapshots(spark, root, "hunts.csv", SESSIONS, n), ["id"])
    numbers = {c: lenient_int(F.col(c)) for c in SESSION_NUMBERS}
    return rows.withColumns({**numbers, "hunt_date": parse_session_date(F.col("hunt_date"))})


def all_sessions_of(spark: SparkSession, root: str) -> DataFrame:
    """Sessions of all snapshots, newest row per id, as landed."""
    return latest_by_key(read_csv_snapshots(spark, root, "hunts.csv", SESSIONS), ["id"])


def recent_kills_of(spark: SparkSession, root: str, n: int = 14) -> DataFrame:
    """Kills of the last n snapshots: those of each session's newest snapshot, one row per creature."""
    from ..functions.text import lenient_int

    rows = read_csv_snapshots(spark, root, "hunt_kills.csv", KILLS, n).withColumn("killed", lenient_int(F.col("killed")))
    return latest_by_key(newest_children(rows, "hunt_id"), ["hunt_id", "creature"], [CAPTURE, "killed"])


def land(df: DataFrame, path: str) -> None:
    """Land snapshots once as Parquet partitioned by capture date, so that later windows prune folders."""
    df.repartition(CAPTURE, F.pmod(F.xxhash64(*[c for c in df.columns if c != CAPTURE]), F.lit(16))).write.mode(
        "overwrite"
    ).partitionBy(CAPTURE).parquet(path)


def fold_captures(spark: SparkSession, root: str, file: str, schema: str, store: str, keys: list[str]) -> list[str]:
    """Fold the CSV snapshots that a store has not seen yet into it; which days these were.

    The store is the mapping that never expires: newest row per key over all captures (``keyed_store.read(store, keys,
    ["capture_date"])``). It notes the days it holds, so a later run opens only the files of other days, whichever they
    are: a capture that lands late is folded too, and rows of newer captures stay. Days are read from folder names.
    """
    from . import keyed_store

    seen = set(keyed_store.manifest(spark, store)["notes"].get("days", []))
    listed = with_capture_date(spark.read.format("binaryFile").load(f"{root}/*/{file}").select("path", "_metadata"))
    unseen = listed.filter(~F.col(CAPTURE).cast("string").isin(sorted(seen)))
    new = sorted({(str(r[CAPTURE]), r["path"]) for r in unseen.select(CAPTURE, "path").collect()})  # names of new files only
    if not new:
        return []
    days = sorted({day for day, _ in new})
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    rows = with_capture_date(reader.csv([path for _, path in new]))
    number = max(keyed_store.runs(spark, store), default=-1) + 1
    keyed_store.fold(rows, store, number, keys, [CAPTURE], {"days": sorted(seen | set(days))})
    return days
