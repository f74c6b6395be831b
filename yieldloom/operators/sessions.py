"""Session filters, level brackets, spawn statistics and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order_stats import order_points, value_levels
from .topk import top_per_group

# Level ranges of the rankings, inclusive at both ends: a session on an edge counts in two.
BRACKETS = ((50, 100), (100, 200), (200, 300))
OVERALL = "all"


def bracket_tags(brackets: Sequence[tuple[int, int]] = BRACKETS) -> list[str]:
    return [f"{lo}_{hi}" for lo, hi in brackets]


def recent(df: DataFrame, as_of: Column, days: int, date: str = "hunt_date") -> DataFrame:
    """Rows at most ``days`` old; undated rows drop out. The bound is a constant, so it is pushed down."""
    return df.filter(F.col(date) >= F.date_sub(as_of, days))


def year_floor(df: DataFrame, year: Column, min_year: int, keep_undated: bool) -> DataFrame:
    """Rows of ``min_year`` or later; undated sessions stay, undated estimates do not."""
    kept = year >= min_year
    return df.filter(F.coalesce(kept, F.lit(keep_undated)))


def flag_events(sessions: DataFrame, days: DataFrame, date: str = "hunt_date") -> DataFrame:
    """Sessions with ``event_flag`` 1 on an event day."""
    calendar = F.broadcast(days.select(F.col("date").alias(date), F.lit(1).alias("hit")).distinct())
    return sessions.join(calendar, date, "left").select(
        *sessions.columns, F.coalesce(F.col("hit"), F.lit(0)).cast("bigint").alias("event_flag")
    )


def exclude_events(sessions: DataFrame, days: DataFrame, date: str = "hunt_date") -> DataFrame:
    """Sessions not on an event day. Distinct calendar days are bounded, hence the broadcast."""
    calendar = F.broadcast(days.select(F.col("date").alias(date)).distinct())
    return sessions.join(calendar, date, "left_anti").select(*sessions.columns)


def with_brackets(
    df: DataFrame,
    level: str = "avg_lvl",
    brackets: Sequence[tuple[int, int]] = BRACKETS,
    overall: bool = True,
    when: Column | None = None,
) -> DataFrame:
    """One row per bracket a session falls in (plus one for the overall view); level 0 is in none.

    ``when`` limits which rows enter the brackets; the overall view keeps all.
    """
    sets = with_bracket_sets(df, level, brackets, overall, when)
    return sets.withColumn("bracket", F.explode("brackets")).drop("brackets")


def with_bracket_sets(
    df: DataFrame,
    level: str = "avg_lvl",
    brackets: Sequence[tuple[int, int]] = BRACKETS,
    overall: bool = True,
    when: Column | None = None,
) -> DataFrame:
    """Like ``with_brackets``, but one row per session with all its brackets as a list (``brackets``)."""
    named = F.array(
        *[F.struct(F.lit(f"{lo}_{hi}").alias("tag"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in brackets]
    )
    lvl = F.coalesce(F.col(level), F.lit(0))
    enters = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    fitting = F.transform(
        F.filter(named, lambda b: enters & (lvl != 0) & (lvl >= b["lo"]) & (lvl <= b["hi"])), lambda b: b["tag"]
    )
    tags = F.concat(F.array(F.lit(OVERALL)), fitting) if overall else fitting
    return df.withColumn("brackets", tags)


def spawn_stats(sessions: DataFrame, keys: Sequence[str] = ("spawn",)) -> DataFrame:
    """Per spawn: session count, median and best rates, full-loot count, level range, best session."""
    rows = sessions.filter(F.coalesce(F.col("spawn"), F.lit("")) != "")
    level = F.when(F.col("avg_lvl") != 0, F.col("avg_lvl"))
    basics = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_hunts"),
        F.max("xp_h").alias("max_xp_h"),
        F.max("loot_h").alias("max_profit_h"),
        F.count_if(F.col("supplies_known") != 0).alias("n_full_loot"),
        F.min(level).alias("min_lvl_seen"),
        F.max(level).alias("max_lvl_seen"),
        F.min_by("url", F.struct(-F.col("xp_h"), F.col("id"))).alias("sample_url"),
    )
    # Both medians in one pass: the measure is one more key.
    measures = rows.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.lit("xp").alias("measure"), F.col("xp_h").alias("v")),
                F.struct(F.lit("loot").alias("measure"), F.col("loot_h").alias("v")),
            )
        ).alias("m"),
    ).select(*keys, "m.measure", "m.v")
    long_keys = [*keys, "measure"]
    medians = (
        order_points(
            value_levels(measures, long_keys, F.col("v")),
            long_keys,
            lambda total, rows_: {"low": F.floor((total + 1) / 2), "high": F.floor(total / 2) + 1},
        )
        .withColumn("median", F.expr("(low.value + high.value) div 2"))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("measure") == "xp", F.col("median"))).alias("median_xp_h"),
            F.max(F.when(F.col("measure") == "loot", F.col("median"))).alias("median_profit_h"),
        )
    )
    return basics.join(medians, list(keys)).select(
        *keys, "n_hunts", "median_xp_h", "max_xp_h", "median_profit_h", "max_profit_h",
        "n_full_loot", "min_lvl_seen", "max_lvl_seen", "sample_url",
    )


def top_sessions(bracketed: DataFrame, metric: str, k: int = 50) -> DataFrame:
    """Best k sessions of each bracket by one rate."""
    return top_per_group(bracketed, ["bracket"], [F.desc(metric), F.col("id")], k)


def ranking_view(ranking: DataFrame, metric: str, party: str = "all", search: str = "") -> DataFrame:
    """A ranking narrowed by party size (``2`` means two or more) and by text in the spawn name, best first.

    Every row of the ranking that fits is shown.
    """
    view = ranking
    if party == "2":
        view = view.filter(F.col("party_size") >= 2)
    elif party != "all":
        view = view.filter(F.col("party_size").cast("string") == party)
    if search:
        view = view.filter(F.lower("spawn").contains(search.lower()))
    return view.orderBy(F.desc(metric), "id")


def kpi_best(stats: DataFrame) -> DataFrame:
    """The best spawn by median xp rate and by median loot rate."""
    best = [
        stats.agg(
            F.min_by(F.struct("spawn", metric, "n_hunts"), F.struct(-F.col(metric), F.col("spawn"))).alias("b")
        ).select(
            F.lit(metric).alias("metric"), F.col("b.spawn").alias("spawn"),
            F.col(f"b.{metric}").alias("value"), F.col("b.n_hunts").alias("n_hunts"),
        )
        for metric in ("median_xp_h", "median_profit_h")
    ]
    return best[0].unionByName(best[1])


def run_metrics(flagged: DataFrame, as_of: Column, exp_days: int, profit_days: int, **n_rows: int) -> DataFrame:
    """Counts of one run, one row per metric, by a single pass over the sessions with their ``event_flag``.

    Excluded sessions are counted once. ``n_rows`` are the sizes of further tables, as their writes counted them.
    """
    age = F.datediff(as_of, F.col("hunt_date"))
    usable = F.col("event_flag") == 0
    exp = usable & (age <= exp_days)
    counts = {
        "hunts": F.count_if(usable & (age <= profit_days)),
        "hunts_exp": F.count_if(exp),
        "sessions_le31d": F.count_if(exp & (age <= 31)),
        "sessions_le62d": F.count_if(exp & (age <= 62)),
        "events_excluded": F.count_distinct(F.when(F.col("event_flag") == 1, F.col("id"))),
        **{name: F.lit(n) for name, n in n_rows.items()},
    }
    wide = flagged.agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
    return wide.unpivot([], list(counts), "metric", "value")
