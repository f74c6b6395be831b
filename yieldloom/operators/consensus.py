"""Several evidence sources for a spawn's profit, and their consensus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import confidence_band, ratio
from ..functions.names import norm_name
from ..functions.text import lenient_int, parse_money_range, year_of
from ..session import save
from .names import cluster_names, most_frequent
from .order_stats import order_points, value_levels
from .sessions import OVERALL
from .topk import first_values

# Weight of each kind of evidence in the consensus.
KIND_WEIGHTS = {"computed": 3, "measured": 2, "guide": 1, "community": 1}
COMPUTED_SOURCE, MEASURED_SOURCE, COMMUNITY_SOURCE = "sessions+kills model", "median session loot/h", "players"
COMPARE = ["bracket", "spawn", "kind", "source", "lo", "hi", "n", "date", "url"]


def _own(df: DataFrame, kind: str, source: str, amount: str, n: str, as_of: Column, url: Column) -> DataFrame:
    return df.filter(F.col(amount) > 0).select(
        "bracket", "spawn", F.lit(kind).alias("kind"), F.lit(source).alias("source"),
        F.col(amount).alias("lo"), F.col(amount).alias("hi"), F.col(n).cast("string").alias("n"),
        F.date_format(as_of, "yyyy-MM-dd").alias("date"), url.alias("url"),
    )


def guide_rows(guides: DataFrame, min_year: int) -> DataFrame:
    """Guide estimates of ``min_year`` or later: one missing or zero end takes the other's value.

    A guide row counts once, however often it was noted.
    """
    # A plain number of either sign; text that is none drops the row.
    def amount(c: str) -> Column:
        return F.when(F.trim(F.col(c)).rlike(r"^[+-]?\d+\.?\d*$"), lenient_int(F.col(c)))

    def unreadable(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != "") & amount(c).isNull()

    lo, hi = amount("profit_lo"), amount("profit_hi")
    return (
        guides.filter((year_of(F.col("source_date")) >= min_year) & ~unreadable("profit_lo") & ~unreadable("profit_hi"))
        .filter(lo.isNotNull() | hi.isNotNull())
        .select(
            F.col("bracket").alias("guide_bracket"), "spawn",
            F.concat("source", F.lit(" ("), "source_date", F.lit(")")).alias("source"),
            F.coalesce(F.nullif(lo, F.lit(0)), hi, F.lit(0)).alias("lo"),
            F.coalesce(F.nullif(hi, F.lit(0)), lo, F.lit(0)).alias("hi"),
            F.col("source_date").alias("date"),
        )
        .distinct()
    )


def claim_rows(claims: DataFrame, min_year: int) -> DataFrame:
    """Players' claims of ``min_year`` or later with a readable profit."""
    return (
        claims.filter((year_of(F.col("date")) >= min_year) & (F.coalesce(F.col("profit_h"), F.lit("")) != ""))
        .withColumn("range", parse_money_range(F.col("profit_h")))
        .filter(F.col("range").isNotNull())
        .select("spawn", F.col("range.lo").alias("lo"), F.col("range.hi").alias("hi"), "date", "url")
    )


def evidence(
    profit: DataFrame, stats: DataFrame, guides: DataFrame, claims: DataFrame,
    as_of: Column, min_year: int, brackets: Sequence[str],
) -> DataFrame:
    """Union of the four kinds under one schema, per bracket and overall.

    ``profit`` and ``stats`` carry a bracket column. A guide row counts overall and in its own bracket;
    a claim names no bracket and counts in every one.
    """
    computed = _own(profit, "computed", COMPUTED_SOURCE, "profit_computed_h", "n_sessions", as_of, F.lit(""))
    measured = _own(stats, "measured", MEASURED_SOURCE, "median_profit_h", "n_hunts", as_of, F.col("sample_url"))
    every = [OVERALL, *brackets]
    own = F.filter(F.array(*[F.lit(b) for b in brackets]), lambda b: b == F.col("guide_bracket"))
    guide = guide_rows(guides, min_year).select(
        F.explode(F.concat(F.array(F.lit(OVERALL)), own)).alias("bracket"), "spawn", F.lit("guide").alias("kind"),
        "source", "lo", "hi", F.lit("").alias("n"), "date", F.lit("").alias("url"),
    )
    community = claim_rows(claims, min_year).select(
        F.explode(F.array(*[F.lit(b) for b in every])).alias("bracket"), "spawn", F.lit("community").alias("kind"),
        F.lit(COMMUNITY_SOURCE).alias("source"), "lo", "hi", F.lit("").alias("n"), "date", "url",
    )
    out = computed
    for part in (measured, guide, community):
        out = out.unionByName(part)
    return out


def profit_compare(rows: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Evidence with the cluster of its spawn, and the clusters' members (bracket, spawn, cluster)."""
    rows = save(rows, "evidence")
    members = cluster_names(rows.select("bracket", "spawn"), "spawn", scope="bracket", threshold=threshold)
    members = save(members.withColumn("norm", norm_name(F.col("spawn"))), "clusters")
    stamped = rows.join(members, ["bracket", "spawn"])
    return stamped, members.drop("norm")


def consensus(compared: DataFrame) -> DataFrame:
    """Per cluster the weighted median of range middles, the spread and where it comes from.

    Middles are kept doubled, so that they stay whole numbers.
    """
    keys = ["bracket", "cluster"]
    compared = save(compared.select(*keys, "spawn", "kind", "source", "lo", "hi"), "compared")
    weights = F.create_map(*[F.lit(x) for pair in KIND_WEIGHTS.items() for x in pair])
    weight = F.coalesce(F.try_element_at(weights, F.col("kind")), F.lit(1)).cast("bigint")
    levels = value_levels(compared, keys, F.col("lo") + F.col("hi"), weight)
    middle = order_points(levels, keys, lambda total, rows: {"half": F.ceil(total / 2)})
    span = compared.groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n_sources"),
        F.count_distinct("spawn").alias("n_members"),
    )
    shown = most_frequent(compared, keys, "spawn", "spawn")
    sources = first_values(
        compared.select(*keys, F.concat_ws(":", "kind", "source").alias("source")), keys, "source", 8, "|", "sources"
    )
    value = F.col("half.value")
    return (
        span.join(middle, keys).join(shown, keys).join(sources, keys)
        .select(
            "bracket", "spawn", "cluster",
            F.expr("half.value div 2").alias("consensus_h"),
            ratio((F.col("hi") - F.col("lo")) * 2, F.abs(value), 2).alias("spread"),
            "n_sources", "n_members", "sources",
        )
    )


def profit_view(agreed: DataFrame, members: DataFrame, bracket: str, search: str = "") -> DataFrame:
    """Whole consensus of one bracket, best first, with the agreement of its sources.

    The search text may match the shown name or any member of the cluster.
    """
    view = agreed.filter(F.col("bracket") == bracket)
    if search:
        named = members.filter((F.col("bracket") == bracket) & F.lower("spawn").contains(search.lower()))
        view = view.join(named.select("cluster").distinct(), "cluster", "left_semi")
    return view.orderBy(F.desc("consensus_h"), "cluster").select(
        "spawn", "consensus_h", "n_sources", "spread", confidence_band(F.col("spread")).alias("agreement")
    )


def guide_fallback(agreed: DataFrame, guides: DataFrame, brackets: Sequence[str], least: int = 3) -> DataFrame:
    """Brackets with fewer than ``least`` consensus rows get the guides' estimates added."""
    listed = guides.sparkSession.createDataFrame([(b,) for b in brackets], "bracket string")
    counts = agreed.groupBy("bracket").agg(F.count(F.lit(1)).alias("n"))
    short = listed.join(counts, "bracket", "left").filter(F.coalesce("n", F.lit(0)) < least).select("bracket")
    none = F.lit(None).cast("bigint")
    shown = agreed.join(F.broadcast(listed), "bracket", "left_semi").select(
        "bracket", F.lit("consensus").alias("origin"), "spawn", none.alias("exp_lo"), none.alias("exp_hi"),
        F.col("consensus_h").alias("profit_lo"), F.col("consensus_h").alias("profit_hi"), "sources",
    )
    tag = F.replace(F.col("bracket"), F.lit("-"), F.lit("_"))
    estimates = guides.withColumn("bracket", tag).join(F.broadcast(short), "bracket", "left_semi").select(
        "bracket", F.lit("guide").alias("origin"), "spawn",
        *[F.col(c).try_cast("bigint").alias(c) for c in ("exp_lo", "exp_hi", "profit_lo", "profit_hi")],
        F.concat("source", F.lit(" ("), "source_date", F.lit(")")).alias("sources"),
    )
    return shown.unionByName(estimates)
