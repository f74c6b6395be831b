"""Session settings and the shared folder used for checkpoints and interim tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", app: str = "yieldloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("YIELDLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables: keep all cores busy instead of merging everything into one partition.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting falls back to a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="yieldloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, label: str) -> DataFrame:
    """Write an interim table below the shared folder and read it back.

    For results that several later steps read: they are computed once, survive lost executors, and
    the steps see a plain scan with sizes and column pruning instead of the whole plan behind it.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``save`` with the number of rows, which the write counts as it goes: no scan of its own."""
    written = Observation()
    saved = save(df.observe(written, F.count(F.lit(1)).alias("n_rows")), label)
    return saved, written.get["n_rows"]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so an iterative job neither grows its plan nor loses its rounds."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
