"""Lenient parsing of text fields: dates, durations, integers, money ranges."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations and names in calendar order.
MONTH_ABBREVIATIONS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
MONTH_NAMES = (
    "january february march april may june july august september october november december"
).split()

# The named character references of HTML, by name without its ampersand, from the standard library.
NAMED_REFERENCES = {name.rstrip(";"): char for name, char in html5.items() if name.endswith(";")}

BLANKS = " \t\r\n\f"
_SESSION_DATE = r"(?i)^([a-z]{3})\s+(\d{1,2}),\s+(\d{4})\s+([01]?\d|2[0-3]):([0-5]?\d)$"
_DURATION = r"^(?:(\d+)\s*d\s*)?(\d+):(\d+)\s*h"
_DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _literals(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """DATE from three numbers, null where the calendar has no such day."""
    iso = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return F.when(month > 0, iso).try_cast("date")


def parse_session_date(text: Column) -> Column:
    """``Jul 07, 2026 10:44`` -> DATE; anything else -> null."""
    t = F.trim(text)
    month = F.array_position(
        _literals(MONTH_ABBREVIATIONS), F.lower(F.regexp_extract(t, _SESSION_DATE, 1))
    )
    return calendar_date(
        F.regexp_extract(t, _SESSION_DATE, 3).try_cast("int"),
        month,
        F.regexp_extract(t, _SESSION_DATE, 2).try_cast("int"),
    )


def parse_duration(text: Column) -> Column:
    """``1d 02:00h`` -> 1560 minutes; no match -> null."""
    t = F.trim(text)

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(t, _DURATION, i).try_cast("bigint"), F.lit(0))

    return F.when(t.rlike(_DURATION), part(1) * 1440 + part(2) * 60 + part(3))


def lenient_int(text: Column) -> Column:
    """Whole number from text, cut toward zero; empty or bad text -> 0."""
    t = F.trim(text)
    number = F.when(t.rlike(_DECIMAL_TEXT), t.try_cast("double"))
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def first_number(text: Column) -> Column:
    """First signed whole number after removing commas and blanks; none -> 0."""
    digits = F.regexp_extract(F.regexp_replace(F.coalesce(text, F.lit("")), "[, ]", ""), r"-?\d+", 0)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def digits_only(text: Column) -> Column:
    """Number made of all digits in the text; no digit -> null."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def year_of(text: Column) -> Column:
    """Year from the first four characters; bad text -> null."""
    return F.regexp_extract(text, r"^(\d{4})", 1).try_cast("int")


def _amount(text: Column) -> Column:
    pattern = r"^([\d.,]+)(kk|k)?"
    number = F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", ".").try_cast("double")
    suffix = F.regexp_extract(text, pattern, 2)
    factor = F.when(suffix == "kk", 1000000.0).when(suffix == "k", 1000.0).otherwise(1.0)
    return (number * factor).try_cast("bigint")


def parse_money_range(text: Column) -> Column:
    """Money text -> STRUCT<lo, hi>: ``k``/``kk`` suffixes, comma as decimal point, ``-``/``~`` ranges.

    Each end carries its own suffix. Unreadable text -> null.
    """
    t = F.regexp_replace(F.regexp_replace(F.lower(text), "[~–]", "-"), " ", "")
    ends = F.split(t, "-", 2)
    first = _amount(F.get(ends, F.lit(0)))
    second = F.when(F.size(ends) > 1, _amount(F.get(ends, F.lit(1)))).otherwise(first)
    return F.when(
        first.isNotNull() & second.isNotNull(),
        F.struct(F.least(first, second).alias("lo"), F.greatest(first, second).alias("hi")),
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used: inside array functions Spark repeats it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_markup(html: Column) -> Column:
    """Text of an HTML fragment: tags removed, trimmed, character references resolved."""
    return decode_references(F.trim(F.regexp_replace(html, "<[^>]+>", ""), F.lit(BLANKS)))


def decode_references(text: Column) -> Column:
    """Numeric and named character references as their characters, each resolved once; unknown ones stay."""
    # By first letter, since a lookup reads a map from its beginning.
    letters: dict[str, dict[str, str]] = {}
    for name, char in NAMED_REFERENCES.items():
        letters.setdefault(name[0], {})[name] = char
    names = F.from_json(F.lit(json.dumps(letters)), "map<string,map<string,string>>")

    def of_code(code: Column) -> Column:
        usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def resolved(piece: Column) -> Column:
        """A piece that stood behind an ampersand."""
        decimal, hexadecimal, name = (F.regexp_extract(piece, p, 1) for p in (r"^#(\d{1,7});", r"^#[xX]([0-9a-fA-F]{1,6});", r"^([a-zA-Z][a-zA-Z0-9]*);"))
        char = lambda name: (
            F.when(decimal != "", of_code(decimal.try_cast("bigint")))
            .when(hexadecimal != "", of_code(F.conv(hexadecimal, 16, 10).try_cast("bigint")))
            .when(name != "", F.try_element_at(F.try_element_at(names, F.substr(name, F.lit(1), F.lit(1))), name))
        )
        rest = F.regexp_replace(piece, "^[^;]*;", "")
        return F.coalesce(F.concat(bound(name, char), rest), F.concat(F.lit("&"), piece))

    def decoded(t: Column) -> Column:
        pieces = F.split(t, "&")
        joined = bound(pieces, lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), resolved), "")))
        return F.when(t.contains("&"), joined).otherwise(t)

    return bound(text, decoded)


def epoch_text(seconds: Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """Epoch seconds -> formatted text in the session time zone; bad or missing -> null."""
    return F.date_format(F.timestamp_seconds(seconds.try_cast("double")), pattern)


def event_days(text: Column, year: Column) -> Column:
    """Days named in prose, as a sorted ARRAY<DATE>.

    ``between the server saves of <Month> d and [<Month>] d`` gives every day of the range. Only when
    no range yields a day do single ``<Month> d`` mentions count.
    """
    # Fixed value: how the texts put a range.
    ranged = r"between the server saves of ([A-Z][a-z]+) (\d{1,2}) and ([A-Z][a-z]+)? ?(\d{1,2})"
    single = "(" + "|".join(m.capitalize() for m in MONTH_NAMES) + r") (\d{1,2})"
    months = _literals(MONTH_NAMES)

    def day(month_name: Column, number: Column) -> Column:
        return calendar_date(year, F.array_position(months, F.lower(month_name)), number.try_cast("int"))

    def mentioned(pattern: str) -> Column:
        """Matches as they stand in the text: one pass over it; groups are read from the short matches."""
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def group(match: Column, pattern: str, n: int) -> Column:
        return F.regexp_extract(match, pattern, n)

    spans = F.transform(
        mentioned(ranged),
        lambda m: F.struct(
            day(group(m, ranged, 1), group(m, ranged, 2)).alias("a"),
            day(F.coalesce(F.nullif(group(m, ranged, 3), F.lit("")), group(m, ranged, 1)), group(m, ranged, 4)).alias("b"),
        ),
    )
    spans = F.filter(spans, lambda s: s["a"] <= s["b"])
    days = F.flatten(F.transform(spans, lambda s: F.sequence(s["a"], s["b"])))
    mentions = F.transform(mentioned(single), lambda m: day(group(m, single, 1), group(m, single, 2)))
    mentions = F.filter(mentions, lambda d: d.isNotNull())
    return F.array_sort(F.array_distinct(F.when(F.size(days) > 0, days).otherwise(mentions)))
