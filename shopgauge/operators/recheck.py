"""Re-check of limits: drop out-of-control points and compute the limits again from the rest."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.operators import fixed_values as fixed
from shopgauge.operators.keyed import first_n
from shopgauge.operators.limits import chart_class, limit_columns, with_constants
from shopgauge.schema import KEY, LIMIT_COLUMNS

KEEP, UPDATE, DELETE = "keep", "update", "delete"


def relimit(
    results: DataFrame,
    newest: int = 25,
    excluded_plants: Sequence[str] = tuple(fixed.RECHECK_EXCLUDED_PLANTS),
    classes: Sequence[str] | None = None,
) -> DataFrame:
    """What to do with the limits of each process that has enough judged points, by its newest ones.

    All clean: keep. Some clean: new limits from those, at the sample size of the newest point, with
    plain means of the point values. None clean: delete. With `classes` only limits of those chart
    classes are computed again. Sizes that have no constants keep their limits.
    """
    scoped = results
    if excluded_plants:
        # A process without a plant is in none of the excluded ones.
        scoped = results.filter(F.coalesce(~F.col("factory").isin(list(excluded_plants)), F.lit(True)))
    recent = first_n(scoped, KEY, [F.desc("time"), F.desc("id_no")], newest)
    clean = F.col("spcwarn") == ""
    checked = (
        recent.groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("_points"),
            F.count(F.when(clean, 1)).alias("clean_points"),
            F.avg(F.when(clean, F.col("testvalueavg"))).alias("_centre"),
            F.avg(F.when(clean, F.col("testvaluerange"))).alias("_range"),
            F.avg(F.when(clean, F.col("testvaluestdev"))).alias("_stddev"),
            F.min_by("samplenum", "num").alias("pcs"),
        )
        .filter(F.col("_points") >= newest)
    )
    can_update = F.col("pcs").between(1, 25)
    if classes is not None:
        can_update = can_update & chart_class(F.col("pcs")).isin(list(classes))
    action = (
        F.when(F.col("clean_points") == 0, F.lit(DELETE))
        .when((F.col("clean_points") < newest) & can_update, F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    sized = checked.withColumns({"action": action, "_size": F.least("pcs", F.lit(25))})
    limited = with_constants(sized, "_size").withColumns(
        limit_columns(F.col("pcs"), F.col("_centre"), F.col("_range"), F.col("_stddev"))
    )
    updated = F.col("action") == UPDATE
    return limited.select(
        *KEY,
        "action",
        "clean_points",
        "pcs",
        *[F.when(updated, F.col(c)).alias(c) for c in LIMIT_COLUMNS],
    )
