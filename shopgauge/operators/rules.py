"""Out-of-control rules over chart points, and the judging job."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from shopgauge.functions.ids import row_id
from shopgauge.operators import fixed_values as fixed
from shopgauge.operators.keyed import join_same, look_back
from shopgauge.schema import KEY, LIMIT_COLUMNS, RESULTS

POINT_ORDER = ["mdate", "id_no"]

# Points each rule looks back.
DEPTH = {1: 0, 2: 2, 3: 4, 4: 5}

# (points column, upper limit, lower limit) of the three measures a point may have.
MEASURES = {
    "avg": ("avgvalue", "avgucl", "avglcl"),
    "range": ("rangevalue", "rangeucl", "rangelcl"),
    "stddev": ("stddevvalue", "stddevucl", "stddevlcl"),
}


def _earlier(value: str, depth: int) -> list[str]:
    """Names of the `depth` values before a point, newest first."""
    return [f"{value}_{i}" for i in range(1, depth + 1)]


def earlier_values(value: str, depth: int, window: WindowSpec) -> dict[str, Column]:
    return {name: F.lag(value, i).over(window) for i, name in enumerate(_earlier(value, depth), 1)}


def outside(value: str, ucl: str, lcl: str) -> Column:
    """Rule 1: the value lies outside its limits."""
    return F.expr(f"{value} > {ucl} OR {value} < {lcl}")


def _beyond(value: str, ucl: str, lcl: str, share: int, need: int, depth: int) -> Column:
    """The point and `need` of the `depth` before it lie beyond share/3 of the limit distance, on one side.

    NULL when one of the earlier values is missing.
    """
    centre = f"(({ucl} + {lcl}) / 2)"
    distance = f"greatest(({ucl} - {centre}) * {share} / 3, 0D)"

    def side(sign: str) -> str:
        def far(v):
            return f"{sign}({v} - {centre}) > {distance}"

        count = " + ".join(f"int({far(v)})" for v in _earlier(value, depth))
        return f"({far(value)} AND {count} >= {need})"

    return F.expr(f"{side('')} OR {side('-')}")


def two_of_three(value: str, ucl: str, lcl: str) -> Column:
    """Rule 2: the point and one of the two before it beyond two thirds."""
    return _beyond(value, ucl, lcl, share=2, need=1, depth=2)


def four_of_five(value: str, ucl: str, lcl: str) -> Column:
    """Rule 3: the point and three of the four before it beyond one third."""
    return _beyond(value, ucl, lcl, share=1, need=3, depth=4)


def six_in_a_row(value: str, mode: str = "monotone") -> Column:
    """Rule 4: six points rising or falling.

    Mode "compat" compares the point with the oldest of the five, which then have to run the other way.
    """
    earlier = _earlier(value, 5)
    chain = [value, *(earlier if mode == "monotone" else reversed(earlier))]
    rising, falling = (" AND ".join(f"{a} {sign} {b}" for a, b in zip(chain, chain[1:])) for sign in "><")
    return F.expr(f"({rising}) OR ({falling})")


def attach_limits(points: DataFrame, limits: DataFrame) -> DataFrame:
    """Points with the limits of their process; the join strategy is left to the sizes found at run time."""
    return join_same(points, limits.select(*KEY, "pcs", "usl", "lsl", *LIMIT_COLUMNS), KEY)


def flag_rules(
    points: DataFrame,
    limits: DataFrame,
    rules: Iterable[int] = (1, 2, 3, 4),
    mode: str = "monotone",
    slots: int | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Points with their limits and a flag `<measure>_<rule>` for each measure and rule.

    A flag is NULL or false when the rule does not fire: too few earlier points, or a gap among them.
    """
    rules = sorted(rules)
    depth = max(DEPTH[rule] for rule in rules)
    joined = attach_limits(points, limits)
    flags, used = {}, []
    for name, (value, ucl, lcl) in MEASURES.items():
        used += _earlier(value, depth)
        made = {
            1: lambda: outside(value, ucl, lcl),
            2: lambda: two_of_three(value, ucl, lcl),
            3: lambda: four_of_five(value, ucl, lcl),
            4: lambda: six_in_a_row(value, mode),
        }
        flags |= {f"{name}_{rule}": made[rule]() for rule in rules}
    if depth == 0:
        return joined.withColumns(flags)

    def lags(window: WindowSpec) -> dict[str, Column]:
        found = {}
        for value, _, _ in MEASURES.values():
            found |= earlier_values(value, depth, window)
        return found

    return look_back(joined, KEY, POINT_ORDER, depth, lags, slots, cuts).withColumns(flags).drop(*used)


def judge(
    points: DataFrame,
    limits: DataFrame,
    rules: Iterable[int] = (1, 2, 3, 4),
    mark: Column | None = None,
    mode: str = "monotone",
    need_stddev_limits: bool = False,
    slots: int | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Judge every point: the warnings as text (empty when there are none) and the kind of chart.

    Rules 2 and 3 are judged on individual charts only. Points that lack a value their chart needs are
    left out, after the windows, since they still break a run. Points that are not newer than `mark` are
    context only. `cuts` are the slots of long processes, such as those the points were charted in.
    """
    rules = sorted(rules)
    flagged = flag_rules(points, limits, rules, mode, slots, cuts)
    if mark is not None:
        flagged = flagged.filter(F.col("mdate") > mark)
    single, ranged, deviated = F.col("pcs") == 1, F.col("pcs").between(2, 5), F.col("pcs") >= 6
    has_stddev = F.col("stddevvalue").isNotNull()
    if need_stddev_limits:
        has_stddev = has_stddev & F.col("stddevucl").isNotNull() & F.col("stddevlcl").isNotNull()
    spread_there = F.when(deviated, has_stddev).otherwise(F.col("rangevalue").isNotNull())
    kept = flagged.filter(F.col("avgvalue").isNotNull() & spread_there)

    warnings = []
    for rule in rules:
        number = fixed.RULE_NUMBERS[rule]
        for name, flag, chart in (
            (fixed.SINGLE, f"avg_{rule}", single),
            (fixed.MEAN, f"avg_{rule}", ~single),
            (fixed.RANGE, f"range_{rule}", single | ranged),
            (fixed.STDDEV, f"stddev_{rule}", deviated),
        ):
            if rule in (2, 3):
                chart = chart & single
            warnings.append(F.when(chart & F.col(flag), F.lit(name + number)))
    graph = (
        F.when(single, F.lit(fixed.CHART_INDIVIDUAL))
        .when(ranged, F.lit(fixed.CHART_MEAN_RANGE))
        .when(deviated, F.lit(fixed.CHART_MEAN_STDDEV))
    )
    return kept.select(
        row_id([*KEY, "id_no"]).alias("id"),
        F.col("mdate").alias("time"),
        *KEY,
        "id_no",
        "rcard",
        F.col("pcs").alias("samplenum"),
        "usl",
        "lsl",
        *LIMIT_COLUMNS,
        F.col("avgvalue").alias("testvalueavg"),
        F.col("rangevalue").alias("testvaluerange"),
        F.col("stddevvalue").alias("testvaluestdev"),
        F.array_join(F.array(*warnings), ", ").alias("spcwarn"),
        graph.alias("spcgraphtype"),
    ).select(*RESULTS.fieldNames())
