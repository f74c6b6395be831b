"""How much substance a post has: place words, money rates, level mentions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Place and creature words that mark a post as substantive.
PLACE_WORDS = [
    "quara", "werehyena", "cults", "tiger", "spectre", "vampire", "asura", "demon", "roshamuul", "medusa", "lizard",
    "hero", "banuta", "oramond", "glooth", "lava", "reaper", "edron", "darashia", "feyrist", "werelion", "carnivor",
    "pirate", "naga", "falcon", "cobra", "library", "soul war", "ingol", "bashmu", "gazers", "burster", "ripper",
    "werefox", "werebadger", "werebear", "grimvale", "carlin", "yalahar", "port hope", "ankrahmun", "krailos",
    "wreckoning", "nag", "court", "ros", "feru", "prison", "catacombs", "wildlife", "corym", "stonerefiner",
    "scarabs", "wyrms", "dragons", "heroes", "tomb", "crypt",
]

# Patterns for a money rate and for a level mention.
MONEY_RATE = r"\d[\d.,]*\s*(kk?/h|k/h|k\b|kk\b|gp|gold)"
LEVEL_MENTION = r"\b(1[0-9]{2}|[2-9][0-9]{2}|1000)\b[^\n]*\b(lvl|level|ek|ed|rp|ms)\b"


def content_score(text: Column, words: list[str] = PLACE_WORDS) -> Column:
    """Distinct words present + 2 per money rate + 1 for a level mention, over the whole text."""
    low = F.lower(text)
    present = sum((low.contains(w).cast("bigint") for w in words), F.lit(0).cast("bigint"))
    rates = F.regexp_count(text, F.lit("(?i)" + MONEY_RATE)).cast("bigint")
    return present + 2 * rates + low.rlike(LEVEL_MENTION).cast("bigint")
