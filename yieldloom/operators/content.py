"""Posts and comments: which are worth reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.content import content_score
from .topk import top_n

POST_LENGTH, COMMENT_LENGTH = 80, 120


def discussed_posts(posts: DataFrame, n: int = 60) -> DataFrame:
    """Most discussed posts by score plus twice the comments."""
    heat = F.coalesce("score", F.lit(0)) + 2 * F.coalesce("num_comments", F.lit(0))
    return top_n(posts.withColumn("heat", heat), [F.desc("heat"), F.col("id")], n, "position")


def long_enough(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments under one schema (kind, id, score, title, body, url), short ones left out.

    A comment has no title and no link of its own.
    """

    def url(df: DataFrame):
        return F.col("url") if "url" in df.columns else F.lit("")

    body = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("selftext", F.lit("")))
    p = posts.select(
        F.lit("POST").alias("kind"), F.col("id").cast("string").alias("id"), "score", F.coalesce("title", F.lit("")).alias("title"),
        body.alias("body"), F.coalesce(url(posts), F.lit("")).alias("url"),
    )
    c = comments.select(
        F.lit("COMM").alias("kind"), F.col("id").cast("string").alias("id"), "score", F.lit("").alias("title"),
        F.coalesce("body", F.lit("")).alias("body"), F.lit("").alias("url"),
    )
    p = p.filter(F.length(F.trim("body")) > POST_LENGTH)
    return p.unionByName(c.filter(F.length("body") > COMMENT_LENGTH))


def content_rank(posts: DataFrame, comments: DataFrame, n: int = 70) -> DataFrame:
    """Most substantive texts, scored over their whole length, with their texts."""
    scored = long_enough(posts, comments).withColumn("substance", content_score(F.col("body")))
    return top_n(scored, [F.desc("substance"), F.desc("score"), F.col("kind"), F.col("id")], n, "position")
