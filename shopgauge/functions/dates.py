"""Calendar labels. Dates stay DATE inside a plan; labels are text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopgauge.operators.fixed_values import PERIOD_JOIN

# unit name -> (unit of trunc, length of the unit in months, in days)
UNITS = {"week": ("WEEK", 0, 7), "month": ("MONTH", 1, 0), "quarter": ("QUARTER", 3, 0), "year": ("YEAR", 12, 0)}


def unit_begin(day: Column, unit: str) -> Column:
    return F.trunc(day, UNITS[unit][0])


def unit_end(day: Column, unit: str) -> Column:
    """Last day of the unit that `day` lies in."""
    _, months, days = UNITS[unit]
    begin = unit_begin(day, unit)
    following = F.date_add(begin, days) if days else F.add_months(begin, months)
    return F.date_sub(following, 1)


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def span_text(begin: Column, end: Column) -> Column:
    return F.concat_ws(PERIOD_JOIN, day_text(begin), day_text(end))


def short_label(end: Column, unit: str) -> Column:
    """WEEK<n>, yyyy-MM, Q<n> or yyyy, taken from the last day of the period."""
    if unit == "week":
        return F.concat(F.lit("WEEK"), F.weekofyear(end).cast("string"))
    if unit == "month":
        return F.date_format(end, "yyyy-MM")
    if unit == "quarter":
        return F.concat(F.lit("Q"), F.quarter(end).cast("string"))
    return F.date_format(end, "yyyy")


def label_year(begin: Column, end: Column, unit: str) -> Column:
    """Weeks belong to the year they start in, longer periods to the year they end in."""
    return F.date_format(begin if unit == "week" else end, "yyyy")


def row_order(time: str, row_id: str) -> Column:
    """Number that orders rows by a time column and rows of the same microsecond by a hash of their id.

    A decimal, unlike a struct, can sit in a hash aggregate as the ordering of max_by. It holds the
    microseconds and all 64 bits of the hash. It is taken from the fields of the local time, so the
    session time zone plays no part.
    """
    minutes = f"(bigint(datediff({time}, DATE'1970-01-01')) * 1440 + hour({time}) * 60 + minute({time}))"
    micros = f"({minutes} * 60000000 + bigint(extract(SECOND FROM {time}) * 1000000))"
    wide = "decimal(20,0)"
    return F.expr(f"cast(cast({micros} as {wide}) * 18446744073709551616 + cast(xxhash64({row_id}) as {wide}) as decimal(38,0))")
