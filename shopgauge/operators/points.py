"""Chart points: one value and one spread per inspection sheet."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.functions.ids import row_id
from shopgauge.functions.numbers import fixed3
from shopgauge.operators.keyed import join_same, look_back
from shopgauge.operators.slots import cut_points
from shopgauge.operators.subgroups import sheet_stats, states_of
from shopgauge.schema import KEY, POINTS


def limited_measurements(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows whose process has limits, NULL key parts being equal. Limits are unique per key, so this keeps each row once."""
    return join_same(rows, limits.select(*KEY), KEY, "left_semi")


def charted(sheets: DataFrame, cuts: DataFrame | None = None, slots: int | None = None) -> DataFrame:
    """Points of sheets (`sheet_stats`) with their number of readings as `n`.

    A sheet with one reading is charted with its moving range: the spread of its reading and the
    readings of the sheet before. The first sheet of a process has none and gives no point.
    """
    with_previous = look_back(
        sheets,
        KEY,
        ["mdate", "id_no"],
        1,
        lambda window: {
            "_previous_low": F.lag("low").over(window),
            "_previous_high": F.lag("high").over(window),
        },
        slots,
        cuts,
    )
    single = F.col("n") == 1
    moving = F.greatest("high", "_previous_high") - F.least("low", "_previous_low")
    return with_previous.filter(~single | F.col("_previous_low").isNotNull()).select(
        row_id([*KEY, "id_no"]).alias("id"),
        *KEY,
        "id_no",
        "rcard",
        "mdate",
        "n",
        fixed3(F.col("total") / F.col("n")).alias("avgvalue"),
        fixed3(F.when(single, moving).when(F.col("n") <= 5, F.col("span"))).alias("rangevalue"),
        fixed3(F.when(F.col("n") >= 6, F.col("deviation"))).alias("stddevvalue"),
    )


def chart_points(
    rows: DataFrame,
    limits: DataFrame,
    mark: Column | None = None,
    only_single: bool = False,
    slots: int | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Points of all sheets that are newer than `mark` and whose process has limits, from measurements or their sample states.

    The slots of long processes come from the times of the samples, unless `cuts` are given.
    """
    states = states_of(limited_measurements(rows, limits))
    cuts = cut_points(states, KEY, "begin_mdate", slots) if cuts is None else cuts
    points = charted(sheet_stats(states), cuts)
    if only_single:
        points = points.filter(F.col("n") == 1)
    if mark is not None:
        points = points.filter(F.col("mdate") > mark)
    return points.select(*POINTS.fieldNames())
