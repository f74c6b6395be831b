"""Store of dated captures: parents and their children, changed together.

``<root>/<table>/capture_date=<day>/generation=<n>`` holds one table of one capture. A change writes a new generation of the
capture's tables by dynamic partition overwrite, so nothing but that capture is touched, and then creates the marker
``<root>/_commits/<day>.<n>``: readers take the newest marked generation of each day, so parents and children appear
together or not at all. What an attempt leaves that died before its marker is named by no marker; the next attempt takes a
number of its own. Older generations stay for readers at work; whoever owns the store removes them. Writers of one capture take turns: the marker of a second one at the
same time is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.latest import CAPTURE

GENERATION = "generation"


def _differ(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables differ in a row or in how often they have it: one count over both."""
    both = a.withColumn("__more", F.lit(1)).unionByName(b.withColumn("__more", F.lit(-1)))
    return not both.groupBy(*a.columns).agg(F.sum("__more").alias("__more")).filter("__more <> 0").isEmpty()


@dataclass
class CaptureStore:
    """``schemas``: DDL of each table, the parents' first. Children name their parent in ``parent_key``."""

    spark: SparkSession
    root: str
    schemas: dict[str, str]
    key: str = "id"
    parent_key: str = "hunt_id"

    @property
    def parents(self) -> str:
        return next(iter(self.schemas))

    def key_of(self, table: str) -> str:
        return self.key if table == self.parents else self.parent_key

    def _glob(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [f.getPath().toString() for f in found]

    def committed(self) -> dict[str, int]:
        """Newest marked generation of each day, read from the markers' names."""
        out: dict[str, int] = {}
        for path in self._glob("_commits/*"):
            day, _, generation = path.rpartition("/")[2].rpartition(".")
            out[day] = max(out.get(day, -1), int(generation))
        return out

    def _mark(self, day: str, generation: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits/{day}.{generation}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, False).close()

    def read(self, table: str, days: Sequence[str] | None = None) -> DataFrame:
        """A table of all captures, or of the given days, with their ``capture_date``. Other captures stay closed."""
        current = {d: n for d, n in self.committed().items() if days is None or d in days}
        wanted = {f"{CAPTURE}={d}/{GENERATION}={n}" for d, n in current.items()}
        paths = [p for p in self._glob(f"{table}/{CAPTURE}=*/{GENERATION}=*") if "/".join(p.split("/")[-2:]) in wanted]
        schema = StructType.fromDDL(self.schemas[table])
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn(CAPTURE, F.lit(None).cast("date"))
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*schema.fieldNames(), F.col(CAPTURE).cast("date").alias(CAPTURE))

    def last(self, table: str, n: int) -> DataFrame:
        """A table of the last n captures that exist."""
        return self.read(table, sorted(self.committed())[-n:])

    def append(self, day: str, tables: dict[str, DataFrame]) -> bool:
        """Add captured rows to a day: a parent in the new rows replaces its old row and all its old children.

        Children whose parent is not among the new parents are left out; a new parent without children loses those it had.
        Rows that change nothing write nothing; whether something was written is returned.
        """
        new = {t: tables[t].select(*StructType.fromDDL(self.schemas[t]).fieldNames()) for t in self.schemas}
        ids = new[self.parents].select(F.col(self.key).alias("__parent")).distinct()
        nameless = not ids.filter(F.col("__parent").isNull()).isEmpty()
        held, kept, ours = {}, {}, {}
        for table in self.schemas:
            key = F.col(self.key_of(table))

            def of_new(rows: DataFrame) -> DataFrame:
                # By plain equality, so that rows dealt out by this key are not dealt again; a null key is looked up apart.
                found = rows.join(ids, key == F.col("__parent"), "left_semi")
                return found.unionByName(rows.filter(key.isNull())) if nameless else found

            old = self.read(table, [day]).drop(CAPTURE)
            kept[table] = (old.filter(key.isNotNull()) if nameless else old).join(ids, key == F.col("__parent"), "left_anti")
            held[table] = of_new(old)
            ours[table] = new[table] if table == self.parents else of_new(new[table])
        if day in self.committed() and not any(_differ(held[t], ours[t]) for t in self.schemas):
            return False
        self._write(day, {t: kept[t].unionByName(ours[t]) for t in self.schemas})
        return True

    def replace(self, day: str, tables: dict[str, DataFrame]) -> None:
        """Write a day anew, whatever it held."""
        self._write(day, {t: tables[t] for t in self.schemas})

    def _write(self, day: str, tables: dict[str, DataFrame]) -> None:
        used = [int(p.rpartition("=")[2]) for t in self.schemas for p in self._glob(f"{t}/{CAPTURE}={day}/{GENERATION}=*")]
        generation = max([*used, self.committed().get(day, -1)], default=-1) + 1
        for table, rows in tables.items():
            rows = rows.select(*StructType.fromDDL(self.schemas[table]).fieldNames())
            writer = rows.withColumns({CAPTURE: F.lit(day), GENERATION: F.lit(generation)}).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(CAPTURE, GENERATION).parquet(f"{self.root}/{table}")
        self._mark(day, generation)
