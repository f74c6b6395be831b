"""Connected components of links, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)`` for every node of a link; ``root`` is the component's smallest node.

    Each round ties a node's larger neighbours to its smallest one (large star) and then its smaller neighbours as
    well (small star), until nothing changes. A hub's neighbours are rows of a join that Spark may split, and its
    smallest neighbour is an aggregate combined before the shuffle, so no group is gathered in one task. Every round
    is written to the shared folder. Links with a null end and loops are left out.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = save(edges, "links")
    before = None
    while True:
        ways = _both_ways(edges)
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = save(small.filter("u <> v").distinct(), "small-star")
        # A star forest has each node once, below a root that is below nothing; the sum of roots no longer falls then.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    below = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return below.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
