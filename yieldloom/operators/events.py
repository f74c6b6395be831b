"""Event days announced in news texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import event_days, year_of
from .latest import last_captures

# Words that mark a news title as an event.
EVENT_WORDS = (
    "double xp|double exp|double loot|double skill|rapid respawn|double experience|2x xp|2x exp"
).split("|")


def event_news(news: DataFrame, title: str = "title", words: Sequence[str] = EVENT_WORDS) -> DataFrame:
    """News whose title names an event."""
    return news.filter(F.lower(title).rlike("|".join(words)))


def days_from_news(news: DataFrame, title: str = "title", text: str = "text", date: str = "date_text") -> DataFrame:
    """(date, name): every day the news names, each day once."""
    days = news.select(
        F.explode(event_days(F.col(text), year_of(F.col(date)))).alias("date"), F.col(title).alias("name")
    )
    return days.groupBy("date").agg(F.min("name").alias("name"))


def known_event_days(captured: DataFrame, extra: Sequence[str] = (), n: int = 4) -> DataFrame:
    """Distinct event days of the last n captures together with days set by hand."""
    days = last_captures(captured, n).select(F.to_date("date").alias("date")).filter("date is not null")
    by_hand = days.sparkSession.createDataFrame([(d,) for d in extra], "d string").select(F.to_date("d").alias("date"))
    return days.unionByName(by_hand).distinct()
