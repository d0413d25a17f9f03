"""Calendar jobs: ranges split into periods, and a calendar with one row per day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.functions.dates import UNITS, day_text, label_year, short_label, span_text, unit_begin, unit_end


def split_periods(ranges: DataFrame, begin: str, end: str, unit: str) -> DataFrame:
    """One row per period that a range [begin, end] of dates touches, clipped to the range."""
    _, months, days = UNITS[unit]
    step = f"INTERVAL {days} DAYS" if days else f"INTERVAL {months} MONTHS"
    starts = F.sequence(unit_begin(F.col(begin), unit), F.col(end), F.expr(step))
    exploded = ranges.withColumn("_unit", F.explode(starts))
    clipped = exploded.withColumns(
        {
            "period_begin": F.greatest("_unit", begin),
            "period_end": F.least(unit_end(F.col("_unit"), unit), F.col(end)),
        }
    )
    first, last = F.col("period_begin"), F.col("period_end")
    return clipped.drop("_unit").withColumns(
        {
            "period": span_text(first, last),
            "year": label_year(first, last, unit),
            "label": short_label(last, unit),
        }
    )


def days_between(bounds: DataFrame, begin: str, end: str) -> DataFrame:
    """One row per day of each range."""
    return bounds.select(F.explode(F.sequence(begin, end, F.expr("INTERVAL 1 DAY"))).alias("day"))


def calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """Calendar columns for a frame with a date column. Weeks run from Monday, weekday 0 is Sunday."""
    d = F.col(day)
    month_end, season_end = F.last_day(d), unit_end(d, "quarter")
    season_begin = unit_begin(d, "quarter")
    season_months = [F.date_format(F.add_months(season_begin, i), "yyyy-MM") for i in range(3)]
    days_in_season = F.datediff(season_end, season_begin) + 1
    passed_in_season = F.datediff(d, season_begin) + 1
    return days.select(
        day_text(d).alias("day"),
        F.date_format(d, "yyyyMMdd").alias("compact_day"),
        day_text(F.to_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd")).alias("from_compact"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("weekday"),
        F.weekofyear(d).alias("week_of_year"),
        day_text(unit_begin(d, "week")).alias("week_begin"),
        day_text(unit_end(d, "week")).alias("week_end"),
        F.concat_ws(" - ", day_text(unit_begin(d, "week")), day_text(unit_end(d, "week"))).alias("week_label"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        day_text(unit_begin(d, "month")).alias("month_begin"),
        day_text(month_end).alias("month_end"),
        F.dayofmonth(month_end).alias("days_in_month"),
        F.dayofmonth(d).alias("passed_in_month"),
        F.datediff(month_end, d).alias("left_in_month"),
        F.quarter(d).alias("season"),
        F.concat_ws(",", *season_months).alias("season_months"),
        day_text(season_begin).alias("season_begin"),
        day_text(season_end).alias("season_end"),
        days_in_season.alias("days_in_season"),
        passed_in_season.alias("passed_in_season"),
        (days_in_season - passed_in_season).alias("left_in_season"),
    )
