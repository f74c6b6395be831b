"""Canonical forms of free-text place names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that do not tell places apart.
STOPWORDS = [
    "the", "solo", "duo", "trio", "team", "ed", "ek", "rp", "ms", "em", "druid", "knight", "paladin", "sorcerer",
    "monk", "hunt", "party", "north", "south", "east", "west", "upper", "lower", "depot", "dp", "fullmoon", "full",
    "moon", "double", "rapid", "boosted", "boost", "post", "nerf", "teste", "test", "bestiary", "bounty", "with",
    "and", "na", "de", "com", "en", "w", "z", "ze", "do", "no", "nos", "das", "adept", "massive", "soloo", "hunts",
    "boost", "dmg", "dobre", "xp",
]


def canon_tokens(name: Column) -> Column:
    """Distinct meaningful words of a name, sorted; a plural ``s`` is dropped from longer words."""
    t = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\[[^\]]*\]|\([^)]*\)|\|[^|]*\|", " ")
    t = F.regexp_replace(t, "[^a-z0-9 ]", " ")
    words = F.filter(
        F.split(t, " +"),
        lambda w: (F.length(w) > 1) & ~w.rlike("^[0-9]+$") & ~w.isin(STOPWORDS),
    )
    stems = F.transform(
        words,
        lambda w: F.when((F.length(w) > 4) & w.endswith("s"), w.substr(F.lit(1), F.length(w) - 1)).otherwise(w),
    )
    return F.array_sort(F.array_distinct(stems))


def norm_name(name: Column) -> Column:
    """Canonical words joined into one stable key; a name of stopwords only gives ''."""
    return F.array_join(canon_tokens(name), " ")


def singular(name: Column) -> Column:
    """Name without its last ``s``; null for a name that does not end in one."""
    return F.when(name.endswith("s"), name.substr(F.lit(1), F.length(name) - 1))
