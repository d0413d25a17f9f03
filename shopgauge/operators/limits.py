"""Control limits: chart classes, constants, limit formulas and the limits job."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.functions.numbers import fixed3
from shopgauge.operators import fixed_values as fixed
from shopgauge.operators.keyed import join_same
from shopgauge.operators.subgroups import modal_size, process_sheets, sample_of_subgroups, sample_states, subgroup_stats
from shopgauge.schema import KEY, LIMITS
from shopgauge.sources.shared import pinned
from shopgauge.sources.tables import fixed_table

INDIVIDUAL, MEAN_RANGE, MEAN_STDDEV = "individual", "mean_range", "mean_stddev"


def chart_class(n: Column) -> Column:
    return (
        F.when(n == 1, F.lit(INDIVIDUAL))
        .when(n.between(2, 5), F.lit(MEAN_RANGE))
        .when(n >= 6, F.lit(MEAN_STDDEV))
    )


def chart_constants(spark: SparkSession) -> DataFrame:
    """One row per sample size that has limits: 25 rows."""
    rows = [(1, None, None, None, None, None)]
    rows += [(n, a2, d4, None, None, None) for n, (a2, d4) in fixed.A2_D4.items()]
    rows += [(n, None, None, a3, b4, b3) for n, (a3, b4, b3) in fixed.A3_B4_B3.items()]
    columns = {"size": "int", **dict.fromkeys(["a2", "d4", "a3", "b4", "b3"], "double")}
    return fixed_table(spark, columns, rows)


def with_constants(df: DataFrame, size: str) -> DataFrame:
    """Attach the constants of the sample size; sizes without limits drop out."""
    return df.join(F.broadcast(chart_constants(df.sparkSession)), F.col(size) == F.col("size")).drop("size")


def limit_columns(n: Column, centre: Column, spread_range: Column, spread_stddev: Column) -> dict[str, Column]:
    """The six limits from the centre and the mean range or deviation; those of other charts are NULL."""
    single, ranged, deviated = n == 1, n.between(2, 5), n >= 6
    half = (
        F.when(single, fixed.INDIVIDUAL_SPREAD * spread_range)
        .when(ranged, F.col("a2") * spread_range)
        .when(deviated, F.col("a3") * spread_stddev)
    )
    range_ucl = F.when(single, fixed.INDIVIDUAL_RANGE_UCL * spread_range).when(ranged, F.col("d4") * spread_range)
    return {
        "avgucl": fixed3(centre + half),
        "avglcl": fixed3(centre - half),
        "rangeucl": fixed3(range_ucl),
        "rangelcl": F.when(range_ucl.isNotNull(), F.lit(0.0)),
        "stddevucl": fixed3(F.when(deviated, F.col("b4") * spread_stddev)),
        "stddevlcl": fixed3(F.when(deviated, F.col("b3") * spread_stddev)),
    }


def control_limits(
    rows: DataFrame,
    run_time: Column | None = None,
    subgroups: int = 30,
    take: str = "oldest",
    force_n: int | None = None,
    require_spec: bool = True,
    keep_mdate: bool = False,
) -> DataFrame:
    """Limits of every process with enough inspection sheets, from measurements or their sample states.

    Measurements are read once: their states, one row per sample, are pinned, and sheets, spec limits and
    the samples taken all come from those.

    The mean is weighted by sample size, the mean range leaves out samples that have none. A process
    needs `subgroups` different sheets and as many samples with readings. With force_n the sample size
    is not taken from the data; with require_spec a process without any spec limit gets no limits.
    """
    states = rows if "spec_order" in rows.columns else pinned(sample_states(rows))
    process = process_sheets(states).filter(F.col("sheets") >= subgroups)
    centre = (
        sample_of_subgroups(subgroup_stats(states), subgroups, take)
        .groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("_taken"),
            (F.sum("total") / F.sum("n")).alias("_centre"),
            F.avg("range").alias("_range"),
            F.avg("deviation").alias("_stddev"),
            (F.lit(force_n) if force_n else modal_size()).cast("int").alias("pcs"),
        )
        .filter(F.col("_taken") >= subgroups)
    )
    joined = join_same(centre, process, KEY)
    if require_spec:
        joined = joined.filter(F.col("usl").isNotNull() | F.col("lsl").isNotNull())
    limits = with_constants(joined, "pcs").withColumns(
        limit_columns(F.col("pcs"), F.col("_centre"), F.col("_range"), F.col("_stddev"))
    )
    now = F.current_timestamp() if run_time is None else run_time
    limits = limits.withColumn("time", now.cast("timestamp_ntz"))
    return limits.select(*LIMITS.fieldNames(), *(["mdate"] if keep_mdate else []))

