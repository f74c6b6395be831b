"""Room on disk between the steps of a long job."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so when a step's plan is collected as garbage in the driver, which may otherwise be long after the
    step's result has been written. Nothing that is still in use is touched.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
