from datetime import date, datetime, timedelta

import pytest
from frames import START, measurements
from pyspark.sql import functions as F

from shopgauge.operators.capability import capability
from shopgauge.operators.periods import calendar, days_between, split_periods
from shopgauge.operators import slices


def spans(spark, begin, end, unit):
    df = spark.createDataFrame([(begin, end)], "b date, e date")
    return [tuple(r) for r in split_periods(df, "b", "e", unit).orderBy("period_begin").select("period", "year", "label").collect()]


def test_weeks(spark):
    # Begins on a Sunday, spans a year end, ends mid-week.
    assert spans(spark, date(2023, 12, 24), date(2024, 1, 10), "week") == [
        ("2023-12-24至2023-12-24", "2023", "WEEK51"),
        ("2023-12-25至2023-12-31", "2023", "WEEK52"),
        ("2024-01-01至2024-01-07", "2024", "WEEK1"),
        ("2024-01-08至2024-01-10", "2024", "WEEK2"),
    ]
    assert spans(spark, date(2024, 12, 30), date(2025, 1, 5), "week") == [("2024-12-30至2025-01-05", "2024", "WEEK1")]


def test_months_quarters_years(spark):
    assert spans(spark, date(2024, 1, 31), date(2024, 3, 15), "month") == [
        ("2024-01-31至2024-01-31", "2024", "2024-01"),
        ("2024-02-01至2024-02-29", "2024", "2024-02"),
        ("2024-03-01至2024-03-15", "2024", "2024-03"),
    ]
    assert spans(spark, date(2023, 11, 5), date(2024, 6, 30), "quarter") == [
        ("2023-11-05至2023-12-31", "2023", "Q4"),
        ("2024-01-01至2024-03-31", "2024", "Q1"),
        ("2024-04-01至2024-06-30", "2024", "Q2"),
    ]
    assert spans(spark, date(2023, 11, 5), date(2024, 1, 1), "year") == [
        ("2023-11-05至2023-12-31", "2023", "2023"),
        ("2024-01-01至2024-01-01", "2024", "2024"),
    ]
    for unit in ("week", "month", "quarter", "year"):
        assert len(spans(spark, date(2024, 5, 5), date(2024, 5, 5), unit)) == 1


def test_calendar_row(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 20), date(2024, 3, 3))], "b date, e date")
    row = calendar(days_between(bounds, "b", "e")).filter("day = '2024-02-25'").first()
    assert (row.weekday, row.week_of_year, row.week_label) == (0, 8, "2024-02-19 - 2024-02-25")
    assert (row.days_in_month, row.passed_in_month, row.left_in_month) == (29, 25, 4)
    assert (row.season, row.season_months, row.season_begin, row.season_end) == (
        1, "2024-01,2024-02,2024-03", "2024-01-01", "2024-03-31",
    )
    assert (row.days_in_season, row.passed_in_season, row.left_in_season) == (91, 56, 35)
    assert (row.compact_day, row.from_compact, row.year_month) == ("20240225", "2024-02-25", "2024-02")


def cpk(spark, numbers, unit="week", **extra):
    rows = [{"tdata": str(v), **extra} for v in numbers]
    return capability(measurements(spark, rows), unit)


WAVE = [8.0, 12.0] * 16  # mean 10, deviation 2


def indices(df):
    return [tuple(r) for r in df.select("cpuvalue", "cplvalue", "cpkvalue").collect()]


def test_two_sided_and_one_sided(spark):
    assert indices(cpk(spark, WAVE, lower=1.0, upper=25.0)) == [(2.5, 1.5, 1.5)]
    assert indices(cpk(spark, WAVE, lower=None)) == [(1.667, None, 1.667)]
    assert indices(cpk(spark, WAVE, upper=None)) == [(None, 1.667, 1.667)]
    assert indices(cpk(spark, WAVE, lower=None, upper=None)) == []
    assert indices(cpk(spark, WAVE, lower=20.0, upper=20.0)) == []


def test_needs_32_readings_with_a_nonzero_digit(spark):
    assert indices(cpk(spark, WAVE[:31])) == []
    assert indices(cpk(spark, WAVE[:31] + ["0.0"])) == []
    assert len(indices(cpk(spark, WAVE[:30] + ["8.0;12.0;x"]))) == 1


def test_no_deviation_gives_null(spark):
    assert indices(cpk(spark, [10.0] * 32)) == [(None, None, None)]


@pytest.mark.parametrize("shift", [0.0, 1000.0, -50.0])
def test_shifting_everything_changes_nothing(spark, shift):
    moved = cpk(spark, [v + shift for v in WAVE], lower=1.0 + shift, upper=25.0 + shift)
    assert indices(moved) == [(2.5, 1.5, 1.5)]


def test_labels_and_the_last_day(spark):
    rows = [{"tdata": str(v), "mdate": START + timedelta(days=30, hours=23, minutes=i)} for i, v in enumerate(WAVE)]
    frame = measurements(spark, rows)
    month = capability(frame, "month").first()
    assert (month.monthtime, month.year, month.month, month.cpkwarnline) == ("2024-01-01至2024-01-31", "2024", "2024-01", 1.0)
    clipped = capability(frame, "week", F.lit("2024-01-30").cast("date"), F.lit("2024-01-31").cast("date")).first()
    assert (clipped.weektime, clipped.week) == ("2024-01-30至2024-01-31", "WEEK5")
    assert capability(frame, "quarter").first().quarter == "Q1"
    kept = slices.day_span(frame, "mdate", frame.limit(1).select(*[F.lit("2024-01-31").cast("date").alias(c) for c in ("begin", "end")]))
    assert kept.count() == 32


def test_marks(spark):
    default = F.lit("2020-06-01 01:12:51").cast("timestamp_ntz")
    frame = measurements(spark, [{"tdata": "1"} for _ in range(5)])
    none = slices.high_water_mark(frame.limit(0), "mdate", default)
    assert str(none.first().mark) == "2020-06-01 01:12:51"
    some = slices.high_water_mark(frame.filter("id < 3"), "mdate", default)
    high = slices.time_range(frame, "mdate").select("high")
    assert slices.between(frame, "mdate", some.scalar(), high.scalar()).count() == 2
    assert str(frame.limit(1).select(slices.look_back_from(F.lit("2024-03-01 12:00:00").cast("timestamp_ntz"), 1).alias("x")).first().x) == "2024-02-29 00:00:00"


def test_next_bounds(spark):
    done = spark.createDataFrame([(date(2024, 1, 31),), (date(2023, 12, 31),)], "e date")
    day = F.lit("2020-08-01").cast("date")
    as_of = F.lit("2024-02-10").cast("date")
    assert tuple(slices.next_month_bounds(done, "e", day, as_of).first()) == (date(2024, 2, 1), date(2024, 2, 29))
    assert tuple(slices.next_month_bounds(done.limit(0), "e", day, as_of).first()) == (date(2020, 8, 1), date(2024, 2, 29))
    assert slices.next_period_begin(done, "e", day).first().begin == datetime(2024, 2, 1)
