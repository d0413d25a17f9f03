"""From measurement rows to samples: parsed readings, sample statistics, moving range, mode."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shopgauge.functions.dates import row_order
from shopgauge.functions.readings import reading_sum, readings
from shopgauge.operators.keyed import first_n, look_back
from shopgauge.schema import KEY, SUBGROUP

SAMPLE_ORDER = ["mdate", "id_no", "rcard"]


def parse_readings(measurements: DataFrame) -> DataFrame:
    """One row per usable reading, as column `value`."""
    parsed = measurements.withColumn("value", F.explode_outer(readings(F.col("tdata"))))
    return parsed.filter(F.col("value").isNotNull())


#: Columns of a sample's state beside its key. `squares` is the sum of squared distances from the mean of the sample; the orders say
#: which row is the newest one with readings, and which is the newest of all, whose spec limits hold.
STATE = [
    "n", "total", "low", "high", "squares", "newest_row_sum", "newest_order", "begin_mdate", "mdate", "lower", "upper", "spec_order",
]


def sample_states(measurements: DataFrame) -> DataFrame:
    """The state of each sample: all that limits, points and re-checks need of its rows. States of parts of a sample can be merged.

    n = 0 and no statistics without a usable reading; times and spec limits are those of all rows. All buffers are numbers: the map
    tasks aggregate by hash, and the shuffle carries samples, not readings.
    """
    parsed = measurements.withColumn("_readings", readings(F.col("tdata"))).select(
        *KEY,
        *SUBGROUP,
        "mdate",
        "lower",
        "upper",
        "_readings",
        reading_sum(F.col("_readings")).alias("_row_sum"),
        row_order("mdate", "id").alias("_order"),
    )
    # The outer explode keeps the parsing from being repeated in a filter on empty arrays.
    long = parsed.withColumn("value", F.explode_outer("_readings"))
    usable = F.when(F.size("_readings") > 0, F.col("_order"))
    n = F.count("value")
    return long.groupBy(*KEY, *SUBGROUP).agg(
        n.cast("int").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        (F.coalesce(F.var_pop("value"), F.lit(0.0)) * n).alias("squares"),
        F.max_by("_row_sum", usable).alias("newest_row_sum"),
        F.max(usable).alias("newest_order"),
        F.min("mdate").alias("begin_mdate"),
        F.max("mdate").alias("mdate"),
        F.max_by("lower", "_order").alias("lower"),
        F.max_by("upper", "_order").alias("upper"),
        F.max("_order").alias("spec_order"),
    )


def states_of(df: DataFrame) -> DataFrame:
    """Sample states, given those or measurements."""
    return df if "spec_order" in df.columns else sample_states(df)


def _pooled(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """The rows with the mean of their group as `_mean`, and the aggregate that puts their squares together: those about their own means
    and the distances of those from the group's. Window and aggregate share one exchange."""
    group = W.partitionBy(*keys)
    mean = F.sum("total").over(group) / F.nullif(F.sum("n").over(group), F.lit(0))
    apart = F.col("total") / F.nullif(F.col("n"), F.lit(0)) - F.col("_mean")
    moved = F.coalesce(F.sum(F.col("n") * apart * apart), F.lit(0.0))
    # A single part has no distance; its squares stay as they are.
    return rows.withColumn("_mean", mean), F.sum("squares") + F.when(F.count(F.nullif(F.col("n"), F.lit(0))) > 1, moved).otherwise(0.0)


def merge_states(states: DataFrame) -> DataFrame:
    """One state per sample from those of its parts, such as the batches its rows came in."""
    keys = [*KEY, *SUBGROUP]
    rows, squares = _pooled(states, keys)
    return rows.groupBy(*keys).agg(
        F.sum("n").cast("int").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        squares.alias("squares"),
        F.max_by("newest_row_sum", "newest_order").alias("newest_row_sum"),
        F.max("newest_order").alias("newest_order"),
        F.min("begin_mdate").alias("begin_mdate"),
        F.max("mdate").alias("mdate"),
        F.max_by("lower", "spec_order").alias("lower"),
        F.max_by("upper", "spec_order").alias("upper"),
        F.max("spec_order").alias("spec_order"),
    )


def _usable(samples: DataFrame) -> DataFrame:
    deviation = F.sqrt(F.col("squares") / F.col("n"))
    return samples.filter(F.col("n") > 0).withColumns({"span": F.col("high") - F.col("low"), "deviation": deviation})


def subgroup_stats(rows: DataFrame) -> DataFrame:
    """Count, sum, extremes and population deviation of each sample, and the sum of its newest usable row."""
    return _usable(states_of(rows))


def sheet_states(rows: DataFrame) -> DataFrame:
    """Statistics per inspection sheet whatever the run card, under the run card and time of its first row."""
    merged, squares = _pooled(states_of(rows), [*KEY, "id_no"])
    return merged.groupBy(*KEY, "id_no").agg(
        F.min_by("rcard", F.struct("begin_mdate", "rcard")).alias("rcard"),
        F.min("begin_mdate").alias("mdate"),
        F.sum("n").cast("int").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        squares.alias("squares"),
    )


def usable_sheets(sheets: DataFrame) -> DataFrame:
    """Sheet states of the sheets that have readings, with their span and deviation."""
    return _usable(sheets)


def sheet_stats(rows: DataFrame) -> DataFrame:
    """Statistics of the sheets that have readings, from measurements or their sample states."""
    return _usable(sheet_states(rows))


def process_sheets(rows: DataFrame) -> DataFrame:
    """Number of different sheets, newest time and newest spec limits of each process, unusable rows included."""
    return states_of(rows).groupBy(*KEY).agg(
        F.count_distinct("id_no").alias("sheets"),
        F.max("mdate").alias("mdate"),
        F.max_by("lower", "spec_order").alias("lsl"),
        F.max_by("upper", "spec_order").alias("usl"),
    )


def _range(neighbour: Column) -> Column:
    single = F.abs(F.col("total") - neighbour)
    return F.when(F.col("n") == 1, single).otherwise(F.col("span"))


def moving_range(stats: DataFrame, slots: int | None = None, cuts: DataFrame | None = None) -> DataFrame:
    """Range of every sample; a sample of one is compared with the newest row of the next-older sample.

    The oldest sample of a process has no neighbour and, if it holds one reading, no range.
    """
    return look_back(
        stats,
        KEY,
        SAMPLE_ORDER,
        1,
        lambda window: {"range": _range(F.lag("newest_row_sum").over(window))},
        slots=slots,
        cuts=cuts,
    )


def sample_of_subgroups(stats: DataFrame, n: int = 30, take: str = "oldest") -> DataFrame:
    """The n oldest or newest samples of each process, with their (moving) ranges."""
    order = SAMPLE_ORDER
    if take == "oldest":
        chosen = first_n(stats, KEY, [F.asc(c) for c in order], n)
    else:
        # One more sample is kept as the neighbour of the oldest one taken.
        chosen = first_n(stats, KEY, [F.desc(c) for c in order], n + 1)
    neighbour = F.lag("newest_row_sum").over(W.partitionBy(*KEY).orderBy(*order))
    return chosen.withColumn("range", _range(neighbour)).filter(F.col("num") <= n)


def modal_size(column: str = "n") -> Column:
    """Aggregate: the most frequent sample size, the smallest one on a tie."""
    return F.mode(column, deterministic=True)
