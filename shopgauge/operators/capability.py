"""Process capability by calendar period."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.functions.dates import label_year, row_order, short_label, span_text, unit_begin, unit_end
from shopgauge.functions.ids import row_id
from shopgauge.functions.numbers import fixed3
from shopgauge.functions.readings import has_nonzero_digit, readings
from shopgauge.operators import fixed_values as fixed
from shopgauge.schema import KEY

MIN_READINGS = 32
WARN_LINE = 1.0


def day_moments(measurements: DataFrame) -> DataFrame:
    """Count, mean and sum of squares about the mean of each process's readings of a day, and the day's newest spec limits.

    The state that all capability periods are made of: days are merged into weeks, months and quarters, and a day that is kept need not
    be read again. Days without a reading have no row.
    """
    read = measurements.filter((F.col("first_time") == fixed.PATROL) & has_nonzero_digit(F.col("tdata")))
    long = read.select(
        *KEY,
        F.to_date("mdate").alias("day"),
        row_order("mdate", "id").alias("_order"),
        "lower",
        "upper",
        F.explode_outer(readings(F.col("tdata"))).alias("value"),
    ).filter(F.col("value").isNotNull())
    n = F.count("value")
    return long.groupBy(*KEY, "day").agg(
        n.alias("readings"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * n).alias("squares"),
        F.max("_order").alias("spec_order"),
        F.max_by("lower", "_order").alias("lsl"),
        F.max_by("upper", "_order").alias("usl"),
    )


def merged_moments(moments: DataFrame, unit: str) -> DataFrame:
    """Count, mean and population deviation of all readings of a process in a period, and its newest spec limits, from days.

    Several rows of one key and day are put together as well: days of batches, or of keys that were made one.
    """
    rows = moments.withColumn("unit_begin", unit_begin(F.col("day"), unit))
    period = W.partitionBy(*KEY, "unit_begin")
    mean = F.sum(F.col("readings") * F.col("mean")).over(period) / F.sum("readings").over(period)
    apart = F.col("mean") - F.col("_mean")
    squares = F.sum("squares") + F.sum(F.col("readings") * apart * apart)
    return rows.withColumn("_mean", mean).groupBy(*KEY, "unit_begin").agg(
        F.sum("readings").alias("readings"),
        F.max("_mean").alias("mean"),
        F.sqrt(squares / F.sum("readings")).alias("deviation"),
        F.max_by("lsl", "spec_order").alias("lsl"),
        F.max_by("usl", "spec_order").alias("usl"),
    )


def capability(
    rows: DataFrame,
    unit: str,
    begin: Column | None = None,
    end: Column | None = None,
    min_readings: int = MIN_READINGS,
) -> DataFrame:
    """Cpu, Cpl and Cpk of every process and period with enough readings, from measurements or their day moments.

    Two spec limits need upper > lower and give the smaller of the two rounded indices; one limit gives
    its own index. No deviation gives NULL indices. `begin` and `end` (dates) clip the periods' labels;
    the measurements are expected to be cut to them already.
    """
    moments = rows if "spec_order" in rows.columns else day_moments(rows)
    stats = merged_moments(moments, unit).filter(F.col("readings") >= min_readings)
    usl, lsl = F.col("usl"), F.col("lsl")
    stats = stats.filter(F.coalesce(usl > lsl, usl.isNotNull() | lsl.isNotNull()))
    three_sigma = F.nullif(F.col("deviation"), F.lit(0.0))
    first, last = F.col("unit_begin"), unit_end(F.col("unit_begin"), unit)
    first = first if begin is None else F.greatest(first, begin)
    last = last if end is None else F.least(last, end)
    indexed = stats.select(
        *KEY,
        first.alias("_first"),
        last.alias("_last"),
        fixed3(F.abs(usl - F.col("mean")) / 3 / three_sigma).alias("cpuvalue"),
        fixed3(F.abs(F.col("mean") - lsl) / 3 / three_sigma).alias("cplvalue"),
    )
    first, last = F.col("_first"), F.col("_last")
    return indexed.select(
        row_id([F.lit(unit), span_text(first, last), *KEY]).alias("id"),
        span_text(first, last).alias(f"{unit}time"),
        label_year(first, last, unit).alias("year"),
        short_label(last, unit).alias(unit),
        *KEY,
        "cpuvalue",
        "cplvalue",
        F.least("cpuvalue", "cplvalue").alias("cpkvalue"),
        F.lit(WARN_LINE).alias("cpkwarnline"),
    )


def finished(moments: DataFrame, unit: str, as_of: Column, after: Column | None = None) -> DataFrame:
    """Day moments of the periods that ended before the date `as_of`, and begin after the date `after` if there is one."""
    begin = unit_begin(F.col("day"), unit)
    rows = moments.filter(unit_end(begin, unit) < as_of)
    return rows if after is None else rows.filter(begin > after)
