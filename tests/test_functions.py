"""Lenient parsing on single texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from yieldloom.functions import names, rates, text
from yieldloom.functions.content import content_score


def one(spark, column, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [
        ("Jul 07, 2026 10:44", dt.date(2026, 7, 7)),
        (" Jul 7, 2026 10:44 ", dt.date(2026, 7, 7)),
        ("jul 7, 2026 9:05", dt.date(2026, 7, 7)),
        ("Feb 30, 2026 10:44", None),
        ("Jul 07, 2026 25:44", None),
        ("Jul 07, 2026 10:44 CET", None),
        ("Foo 07, 2026 10:44", None),
        ("", None),
        (None, None),
    ],
)
def test_session_date(spark, value, want):
    assert one(spark, text.parse_session_date(F.col("v")), value) == want


@pytest.mark.parametrize(
    "value, want",
    [("01:08h", 68), ("00:28h", 28), ("1d 02:00h", 1560), ("2d2:05 h", 3005), ("n/a", None), ("", None), (None, None)],
)
def test_duration(spark, value, want):
    assert one(spark, text.parse_duration(F.col("v")), value) == want


@pytest.mark.parametrize(
    "value, want",
    [("12", 12), ("12.9", 12), ("-12.9", -12), ("1e3", 1000), ("", 0), ("x", 0), ("nan", 0), ("12d", 0), (None, 0), ("1e30", 0)],
)
def test_lenient_int(spark, value, want):
    assert one(spark, text.lenient_int(F.col("v")), value) == want


@pytest.mark.parametrize("value, want", [("1,234 gp", 1234), ("x -5 y 6", -5), ("5 6", 56), ("none", 0), (None, 0), ("-1,000", -1000)])
def test_first_number(spark, value, want):
    assert one(spark, text.first_number(F.col("v")), value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("150000", (150000, 150000)),
        ("750K~900K", (750000, 900000)),
        ("2.4kk", (2400000, 2400000)),
        ("2,4 kk", (2400000, 2400000)),
        ("300k – 200k", (200000, 300000)),
        ("150-250k", (150, 250000)),
        ("1.234.567", None),
        ("—", None),
        ("-", None),
        ("-5k", None),
        ("", None),
        (None, None),
    ],
)
def test_money_range(spark, value, want):
    got = one(spark, text.parse_money_range(F.col("v")), value)
    assert (None if got is None else tuple(got)) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("Yalahar Cults", "cult yalahar"),
        ("Cults Yalahar (solo) [x] |y|", "cult yalahar"),
        ("Burster Spectre #25", "burster spectre"),
        ("Burster Spectres", "burster spectre"),
        ("EK solo 200", ""),
        (None, ""),
    ],
)
def test_norm_name(spark, value, want):
    assert one(spark, names.norm_name(F.col("v")), value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("between the server saves of September 4 and September 7.", ["09-04", "09-05", "09-06", "09-07"]),
        ("between the server saves of September 4 and 6", ["09-04", "09-05", "09-06"]),
        ("between the server saves of August 30 and September 1", ["08-30", "08-31", "09-01"]),
        ("between the server saves of September 7 and September 4", ["09-04", "09-07"]),
        ("between the server saves of Smarch 4 and Smarch 6", []),
        ("September 4 and October 99, again September 4", ["09-04"]),
        ("nothing", []),
    ],
)
def test_event_days(spark, value, want):
    got = one(spark, text.event_days(F.col("v"), F.lit(2026)), value)
    assert [d.isoformat()[5:] for d in got] == want


def test_decode_references(spark):
    cases = {
        "S&#227;o &eacute;&#x4E2D;&#128512; &amp;lt; a&b &nosuch; &#0; &#xD800; &lt&gt;": "São é中😀 &lt; a&b &nosuch; &#0; &#xD800; &lt>",
        "plain": "plain", "&": "&", "&&amp;;": "&&;", "&CounterClockwiseContourIntegral;x": "∳x",
    }
    for source, want in cases.items():
        assert one(spark, text.decode_references(F.col("v")), source) == want


def test_strip_markup(spark):
    assert one(spark, text.strip_markup(F.col("v")), " <b>a &amp;lt; b</b> &quot;c&quot; ") == 'a &lt; b "c"'


@pytest.mark.parametrize("value, want", [(0.5, "high"), (0.51, "medium"), (1.2, "medium"), (1.21, "low"), (None, "high")])
def test_confidence_band(spark, value, want):
    assert one(spark, rates.confidence_band(F.col("v")), value, "v double") == want


def test_rates(spark):
    df = spark.createDataFrame([(30, 0), (30, 20)], "n int, m int")
    got = df.select(rates.per_hour(F.col("n"), F.col("m")).alias("r")).collect()
    assert [r["r"] for r in got] == [None, 90.0]
    assert one(spark, rates.party_size_of(F.col("v")), "x6+") == 6
    assert one(spark, rates.party_size_of(F.col("v")), "?") == 0


@pytest.mark.parametrize(
    "value, want",
    [("quara and Quara tiger", 2), ("made 100k/h and 2kk/h", 4), ("at level 150 with ek", 1), ("at level 150", 0), ("150 at level", 1), ("", 0)],
)
def test_content_score(spark, value, want):
    assert one(spark, content_score(F.col("v")), value) == want
