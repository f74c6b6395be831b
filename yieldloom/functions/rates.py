"""Rates, fallbacks and labels computed from session numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Party size meant by a query filter label.
PARTY_LABELS = {"Solo": 1, "Duo": 2, "x3": 3, "x4": 4, "x5": 5, "x6+": 6}


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient of whole numbers, rounded half away from zero by whole-number arithmetic.

    Rounding the exact quotient, not its binary approximation, gives the same digits everywhere.
    """
    n, d = numerator.cast("decimal(38,0)"), denominator.cast("decimal(38,0)")
    scaled = F.call_function("div", F.abs(n) * (2 * 10**digits) + F.abs(d), F.abs(d) * 2)
    sign = F.signum(numerator.cast("double")) * F.signum(denominator.cast("double"))
    return F.when(denominator != 0, scaled * sign / float(10**digits))


def per_hour(amount: Column, minutes: Column, digits: int = 1) -> Column:
    """Rate per hour, null when no time passed."""
    return F.when(minutes > 0, ratio(amount * 60, minutes, digits))


def loot_per_hour(loot_total: Column, balance: Column, minutes: Column) -> Column:
    """Loot per hour; a session without a duration falls back to its balance."""
    return F.when(minutes > 0, F.round(loot_total / (minutes / 60.0), 0).cast("bigint")).otherwise(balance)


def party_size_of(label: Column) -> Column:
    """Party size meant by a filter label; unknown label -> 0."""
    sizes = F.create_map(*[F.lit(x) for pair in PARTY_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(sizes, label), F.lit(0))


def bracket_middle(lo: Column, hi: Column) -> Column:
    """Middle of the queried level range; null unless both ends are set."""
    return F.when((lo != 0) & (hi != 0), F.floor((lo + hi) / 2).cast("bigint"))


def confidence_band(spread: Column) -> Column:
    """Agreement of sources from their relative spread: up to 50 % high, up to 120 % medium."""
    percent = F.round(F.coalesce(spread, F.lit(0.0)) * 100, 0)
    return F.when(percent <= 50, "high").when(percent <= 120, "medium").otherwise("low")
