"""Incremental slices. A mark is a one-row frame or a column; it never leaves Spark as a value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, time: str, default: Column, name: str = "mark") -> DataFrame:
    """Newest time in a target table, or the default when the table is empty. One row."""
    return target.agg(F.coalesce(F.max(time), default).alias(name))


def time_range(source: DataFrame, time: str) -> DataFrame:
    """Oldest and newest time of a source. One row."""
    return source.agg(F.min(time).alias("low"), F.max(time).alias("high"))


def between(source: DataFrame, time: str, low: Column, high: Column) -> DataFrame:
    """Rows after `low` up to and with `high`. Literals reach the file scan; scalar subqueries run first."""
    return source.filter((F.col(time) > low) & (F.col(time) <= high))


def look_back_from(mark: Column, days: int) -> Column:
    """Start of a slice that also holds the rows of the `days` days before the day of the mark."""
    return F.date_sub(F.to_date(mark), days).cast("timestamp_ntz")


def next_month_bounds(finished: DataFrame, month_end: str, default: Column, as_of: Column) -> DataFrame:
    """First day after the last finished month, and the last day of the current month. One row."""
    last = F.max(month_end)
    begin = F.coalesce(F.add_months(F.trunc(last, "MM"), 1), default)
    return finished.agg(begin.alias("begin"), F.last_day(as_of).alias("end"))


def next_period_begin(finished: DataFrame, period_end: str, default: Column) -> DataFrame:
    """The first moment of the day after the last finished period. One row; a time, so that a scan can use it as it is."""
    return finished.agg(F.coalesce(F.date_add(F.max(period_end), 1), default).cast("timestamp_ntz").alias("begin"))


def day_bounds(bounds: DataFrame, begin: str = "begin", end: str = "end") -> DataFrame:
    """The first moment of the first day and the first one after the last day of a one-row frame of dates."""
    return bounds.select(F.col(begin).cast("timestamp_ntz").alias(begin), F.date_add(end, 1).cast("timestamp_ntz").alias(end))


def day_span(source: DataFrame, time: str, bounds: DataFrame) -> DataFrame:
    """Rows of the days begin..end of a one-row frame, the whole last day included. The bounds are scalars that reach the file scan."""
    moments = day_bounds(bounds)
    return source.filter((F.col(time) >= moments.select("begin").scalar()) & (F.col(time) < moments.select("end").scalar()))
