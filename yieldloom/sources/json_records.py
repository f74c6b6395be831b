"""Records of large JSON documents, read by as many tasks as a document has splits.

A document is one object or array, possibly of many gigabytes. The text source cuts it at every comma, which splits need no
knowledge of the document for; the rest are running sums. Quotes tell which fragments begin inside a string, brackets
outside strings how deep each begins, and a fragment that begins outside strings one level deep is the first of a record.
Within a split the sums run over its fragments; what earlier splits carry over (an open string, a depth, a number of
records) is added from one row a split. Records that lie within one split are put together there, and only a split's first
and last record are stitched with those of its neighbours.

No fragment or record is longer than what stands between two commas, or one record; no task holds a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.latest import CAPTURE
from ..session import cut_lineage
from .snapshots import DAY_FOLDER, snapshot_paths

SPLIT = ["path", "block"]


def _depth_change(text: Column) -> Column:
    """Brackets opened less brackets closed in a text without strings."""
    bare = F.regexp_replace(text, r"[^\[\]{}]", "")
    opened = F.length(F.regexp_replace(bare, r"[\]}]", ""))
    return opened * 2 - F.length(bare)


def fragments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, block, place, text, first, quotes, outside, inside, capture_date)``: what stands between commas, in order of place within a split.

    ``outside`` and ``inside`` are the changes of depth if the fragment begins outside or inside a string. An escape is two
    characters and never ends at a comma, so it lies within a fragment.
    """
    read = spark.read.option("lineSep", ",").text(paths).select("value", "_metadata")
    day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER, 1).try_cast("date")
    rows = read.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"), day.alias(CAPTURE),
        F.regexp_replace("value", r"\\.", "").alias("plain"),
    )
    quotes = F.length("plain") - F.length(F.replace("plain", F.lit('"'), F.lit("")))
    strings = r'"[^"]*("|$)'
    return rows.select(
        *SPLIT, "place", "text", CAPTURE, F.regexp_extract("text", r"^\s*(\S)", 1).alias("first"), quotes.alias("quotes"),
        _depth_change(F.regexp_replace("plain", strings, "")).alias("outside"),
        _depth_change(F.regexp_replace(F.regexp_replace("plain", r'^[^"]*("|$)', ""), strings, "")).alias("inside"),
    )


def _local(rows: DataFrame) -> DataFrame:
    """Running sums within a split, up to each fragment's begin: whether an odd number of quotes lies before it (``odd``) and
    how far brackets are open if the split begins outside or inside a string (``depth_out``, ``depth_in``)."""
    before = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)

    def running(column: Column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    rows = rows.withColumn("odd", running(F.col("quotes")) % 2 == 1)
    rows = rows.withColumn("if_out", F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside")))
    rows = rows.withColumn("if_in", F.when(F.col("odd"), F.col("outside")).otherwise(F.col("inside")))
    return rows.withColumn("depth_out", running(F.col("if_out"))).withColumn("depth_in", running(F.col("if_in")))


def _first_of_record() -> Column:
    """A fragment that begins outside strings and one level deep, given what its split begins with."""
    depth = F.col("depth0") + F.when(F.col("string0"), F.col("depth_in")).otherwise(F.col("depth_out"))
    return (F.col("odd") == F.col("string0")) & (depth == 1)


def _carried(total: Column) -> Column:
    """What the splits before each one of a document add up to."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(before), F.lit(0))


def _begins(rows: DataFrame) -> DataFrame:
    """One row a split: what it begins with (``string0``, ``depth0``, ``records0``), its records and its document's first character.

    Fragments are folded to how often each state occurs in a split, so what follows is as small as documents are shallow.
    """
    states = _local(rows).groupBy(*SPLIT, "odd", "depth_out", "depth_in").agg(
        F.count(F.lit(1)).alias("fragments"), F.sum("quotes").alias("quotes"), F.sum("if_out").alias("if_out"), F.sum("if_in").alias("if_in"),
        F.min(F.struct("place", "first")).alias("first"),
    )
    states = cut_lineage(states)
    splits = states.groupBy(*SPLIT).agg(F.sum("quotes").alias("q"), F.sum("if_out").alias("out"), F.sum("if_in").alias("in"), F.min("first").alias("first"))
    splits = splits.withColumn("string0", _carried(F.col("q")) % 2 == 1)
    splits = splits.withColumn("change", F.when(F.col("string0"), F.col("in")).otherwise(F.col("out")))
    splits = splits.withColumn("depth0", _carried(F.col("change")))
    counts = states.drop("first").join(splits.select(*SPLIT, "string0", "depth0"), SPLIT).filter(_first_of_record())
    splits = splits.join(counts.groupBy(*SPLIT).agg(F.sum("fragments").alias("n")), SPLIT, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    splits = splits.withColumn("records0", _carried(F.col("n")))
    return cut_lineage(splits.select(*SPLIT, "string0", "depth0", "records0", "n", "q", "change", F.col("first.first").alias("first")))


def split_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, capture_date, root, record, text)``: the members of each document's outermost object or array.

    ``root`` is the document's first character. A document whose brackets or strings are not closed gives none, and
    neither does an empty one. Numbers of records begin at 0. Documents are read twice, the first time for sums alone.
    """
    rows = fragments(spark, paths)
    known = _begins(rows.drop("text", CAPTURE))
    whole = known.groupBy("path").agg(
        F.sum("n").alias("last"), F.sum("change").alias("open"), F.sum("q").alias("quotes"), F.min(F.struct("block", "first")).alias("root")
    )
    whole = whole.filter("open = 0 and quotes % 2 = 0").select("path", "last", F.col("root.first").alias("root"))

    upto = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = _local(rows).join(known.select(*SPLIT, "string0", "depth0", "records0"), SPLIT)
    placed = placed.withColumn("record", F.col("records0") + F.sum(_first_of_record().cast("int")).over(upto))
    piece = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda f: f["text"]), ",")
    parts = placed.groupBy(*SPLIT, "record").agg(piece.alias("text"), F.first(CAPTURE).alias(CAPTURE))
    edge = known.select(*SPLIT, F.col("records0").alias("low"), (F.col("records0") + F.col("n")).alias("high"))
    marked = parts.join(edge, SPLIT).withColumn("edge", (F.col("record") == F.col("low")) | (F.col("record") == F.col("high")))
    alone = marked.filter(~F.col("edge")).select("path", "record", "text", CAPTURE)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda f: f["text"]), ",")
    stitched = marked.filter("edge").groupBy("path", "record").agg(joined.alias("text"), F.first(CAPTURE).alias(CAPTURE))
    records = alone.unionByName(stitched).join(whole, "path").filter(F.col("root").isin("{", "["))
    # The outermost brackets belong to the first and the last record.
    text = F.when(F.col("record") == 0, F.regexp_replace("text", r"^\s*[\[{]", "")).otherwise(F.col("text"))
    text = F.when(F.col("record") == F.col("last"), F.regexp_replace(text, r"[\]}]\s*$", "")).otherwise(text)
    return records.select("path", CAPTURE, "root", "record", text.alias("text")).filter(F.col("text").rlike(r"\S"))


def read_map_records(spark: SparkSession, paths: str | list[str], value: str, key: str = "key") -> DataFrame:
    """Rows ``(capture_date, key, record fields or value)`` of documents that map names to records of a DDL type."""
    parsed = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), f"map<string,{value}>")
    rows = split_records(spark, paths).filter("root = '{'").select(CAPTURE, F.explode(parsed).alias(key, "record"))
    return rows.select(CAPTURE, key, "record.*") if value.lower().startswith("struct") else rows


def read_array_records(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Rows ``(capture_date, fields)`` of documents that are arrays of objects, or one object.

    The members of one object come apart like records and are put together again: such a document is a row.
    """
    split = split_records(spark, paths)
    member = split.filter("root = '['").select(CAPTURE, "text")
    one = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record", "text"))), lambda f: f["text"]), ",")
    single = split.filter("root = '{'").groupBy("path", CAPTURE).agg(one.alias("text"))
    rows = member.unionByName(single.select(CAPTURE, F.concat(F.lit("{"), "text", F.lit("}")).alias("text")))
    parsed = rows.select(CAPTURE, F.from_json("text", schema).alias("r")).filter("r is not null")
    return parsed.select(*[F.col(f"r.{c}") for c in schema.fieldNames()], CAPTURE)


def read_map_captures(spark: SparkSession, root: str, file: str, value: str, key: str = "key", n: int | None = None) -> DataFrame:
    """``read_map_records`` of a dated file's last n snapshots, or of all."""
    paths = snapshot_paths(spark, root, file, n)
    if not paths:
        fields = value[len("struct<") : -1].replace(":", " ") if value.lower().startswith("struct") else f"record {value}"
        return spark.createDataFrame([], f"{CAPTURE} date, {key} string, {fields}")
    return read_map_records(spark, paths, value, key).filter(F.col(CAPTURE).isNotNull())


def read_array_captures(spark: SparkSession, root: str, file: str, schema: str | StructType, n: int | None = None) -> DataFrame:
    """``read_array_records`` of a dated file's last n snapshots, or of all."""
    paths = snapshot_paths(spark, root, file, n)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not paths:
        return spark.createDataFrame([], schema).withColumn(CAPTURE, F.lit(None).cast("date"))
    return read_array_records(spark, paths, schema).filter(F.col(CAPTURE).isNotNull())
