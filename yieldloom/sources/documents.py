"""JSON lines, reference lists and optional files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BROKEN = "_broken"


def parse_json_lines(df: DataFrame, line: Column, schema: str) -> DataFrame:
    """Records of JSON lines; a broken line is dropped, the others stay."""
    full = StructType.fromDDL(schema).add(StructField(_BROKEN, StringType()))
    rest = [c for c in df.columns if c != "value"]
    parsed = F.from_json(line, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = df.select(*rest, parsed.alias("r")).filter(F.col("r").isNotNull() & F.col(f"r.{_BROKEN}").isNull())
    return rows.select(*rest, *[F.col(f"r.{f}") for f in StructType.fromDDL(schema).fieldNames()])


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSONL file or folder, tolerant of broken lines."""
    return parse_json_lines(spark.read.text(path), F.col("value"), schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def read_optional_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV reference list; a missing file is an empty list of the same schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
