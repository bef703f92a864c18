import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from traceops.functions import casts, clock, text
from traceops.functions.buckets import quarter, range_label
from traceops.functions.stats import pearson


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v STRING")


def test_casts_give_null_instead_of_an_error(spark):
    rows = strings(spark, ["1.5", " 2 ", "", "abc", None, "1.9e3", "nan", "1e40"]).select(
        casts.number("v").alias("n"), casts.number_or_zero("v").alias("z"), casts.whole("v").alias("w")).collect()
    assert [r.n for r in rows[:6]] == [1.5, 2.0, None, None, None, 1900.0]
    assert [r.z for r in rows[:6]] == [1.5, 2.0, 0.0, 0.0, 0.0, 1900.0]
    assert [r.w for r in rows] == [1, 2, None, None, None, 1900, None, None]


def test_filled(spark):
    rows = strings(spark, ["a", " ", "", None]).select(casts.filled("v").alias("f")).collect()
    assert [r.f for r in rows] == [True, False, False, None]


def test_share_of_nothing_is_zero(spark):
    assert one(spark, casts.share(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, casts.share(F.lit(1), F.lit(None))) == 0.0
    assert one(spark, casts.share(F.lit(1), F.lit(4), 100.0)) == 25.0


def test_quarter_edges(spark):
    rows = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.2499, 0.25, 0.5, 0.75, 1.0, 2.0)], "v DOUBLE")
    assert [r.q for r in rows.select(quarter("v").alias("q")).collect()] == [0, 0, 0, 1, 2, 3, 3, 3]


def test_range_label():
    assert [range_label(a, b) for a, b in ((0, 0.2), (0.28, 0.29))] == ["0-20%", "28-29%"]


@pytest.mark.parametrize("pairs, expected", [
    ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
    ([(1.0, 1.0), (2.0, 0.0), (None, 5.0), (3.0, None)], -1.0),
    ([(0.1, 1.0), (0.1, 2.0), (0.1, 3.0)], None),
    ([(1.0, 1.0)], None),
    ([], None),
])
def test_pearson(spark, pairs, expected):
    got = spark.createDataFrame(pairs, "x DOUBLE, y DOUBLE").agg(pearson("x", "y").alias("r")).first().r
    assert got == expected if expected is None else got == pytest.approx(expected)


@pytest.mark.parametrize("unit, ts, hour", [
    ("s", 0, 0), ("s", 3599, 0), ("s", 3600, 1), ("s", 86399, 23), ("s", 86400, 0),
    ("s", 300_000_000, 300_000_000 % 86400 // 3600), ("us", 300_000_000, 0),
    ("us", 3_600_000_000, 1), ("us", 86_399_999_999, 23),
    ("s", 2**63 - 1, (2**63 - 1) % 86400 // 3600), ("us", 2**63 - 1, (2**63 - 1) // 10**6 % 86400 // 3600),
])
def test_hour_of_day(spark, unit, ts, hour):
    assert one(spark, clock.hour_of_day(F.lit(ts), unit)) == hour


def test_event_time_units_and_overflow(spark):
    day = datetime.datetime(1970, 1, 2)
    for unit, ts in (("s", 86_400), ("ms", 86_400_000), ("us", 86_400_000_000)):
        assert one(spark, clock.event_time(F.lit(ts), unit).cast("string")) == day.strftime("%Y-%m-%d %H:%M:%S")
    assert one(spark, clock.event_time(F.lit(2**63 - 1), "s")) is None


def test_times_as_text(spark):
    assert one(spark, clock.hms(F.lit(3725.9))) == "01:02:05"
    assert one(spark, clock.hms(F.lit(86_400 + 1))) == "00:00:01"
    assert one(spark, clock.hms(F.lit(None).cast("double"))) is None
    assert one(spark, clock.hms_seconds(F.lit("01:02:05"))) == 3725
    assert one(spark, clock.hms_seconds(F.lit("-"))) is None
    assert one(spark, clock.minutes_label(F.lit(420.38))) == "7:00"
    assert one(spark, clock.minutes_label(F.lit(None).cast("double"))) is None


def python_human(n):
    if n >= 1_000_000:
        return f"{n / 1_000_000:.1f}M"
    return f"{n / 1_000:.1f}k" if n >= 1_000 else str(n)


def test_human_count_at_halves(spark):
    numbers = [*range(950, 60_000, 50), *range(950_000, 30_000_000, 50_000), 999_950, 999_949,
               144_648_288, 37_780, 0, 999, 1_232_799_308, 10**12 + 50_000]
    rows = spark.createDataFrame([(n,) for n in numbers], "n BIGINT").select(
        "n", text.human_count("n").alias("t")).collect()
    assert [(r.n, r.t) for r in rows] == [(n, python_human(n)) for n in numbers]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**13), min_size=200, max_size=400))
def test_human_count_as_python_formats(spark, numbers):
    rows = spark.createDataFrame([(n,) for n in numbers], "n BIGINT").select(
        "n", text.human_count("n").alias("t")).collect()
    assert [r.t for r in rows] == [python_human(r.n) for r in rows]


def test_names(spark):
    assert one(spark, text.file_stem(F.lit("a/b/q5_bonus1_performance.csv"))) == "q5_bonus1_"
    assert one(spark, text.number_in(F.lit("q12_x"), r"q(\d+)")) == 12
    assert one(spark, text.number_in(F.lit("smoke"), r"q(\d+)")) is None
