import random

import pytest
from frames import at, limits, measurements, points
from pyspark.sql import functions as F

from shopgauge.operators.points import chart_points, limited_measurements
from shopgauge.operators.rules import flag_rules, judge


def values(df, *columns):
    return [tuple(r) for r in df.orderBy("mdate" if "mdate" in df.columns else "time").select(*columns).collect()]


def test_points_by_sample_size(spark):
    rows = [
        {"id_no": "a", "tdata": "5"},
        {"id_no": "b", "tdata": "7"},
        {"id_no": "c", "tdata": "1;4"},
        {"id_no": "d", "tdata": "2"},
        {"id_no": "e", "tdata": "9"},
        {"id_no": "f", "tdata": "NG"},
        {"id_no": "g", "tdata": "3"},
        {"id_no": "h", "tdata": "1;2;3;4;5;6"},
    ]
    found = chart_points(measurements(spark, rows), limits(spark, [{}]))
    assert values(found, "id_no", "avgvalue", "rangevalue", "stddevvalue") == [
        ("b", 7.0, 2.0, None),
        ("c", 2.5, 3.0, None),
        # Inside, above and below the readings of the sheet before.
        ("d", 2.0, 3.0, None),
        ("e", 9.0, 7.0, None),
        ("g", 3.0, 6.0, None),
        ("h", 3.5, None, 1.708),
    ]
    single = chart_points(measurements(spark, rows), limits(spark, [{}]), only_single=True)
    assert [v[0] for v in values(single, "id_no")] == ["b", "d", "e", "g"]


def test_points_need_limits_and_may_start_after_a_mark(spark):
    rows = [{"tdata": str(i), "factory": f} for f in "FG" for i in range(5)]
    frame = measurements(spark, rows)
    assert limited_measurements(frame, limits(spark, [{}])).count() == 5
    marked = chart_points(frame, limits(spark, [{}]), mark=F.lit(at(2)).cast("timestamp_ntz"))
    # The sheet at the mark is context for the first point after it.
    assert values(marked, "id_no", "rangevalue") == [("3", 1.0), ("4", 1.0)]


def test_sheet_time_is_that_of_its_first_row(spark):
    rows = [{"id_no": "a", "tdata": "1"}, {"id_no": "b", "tdata": "NG", "rcard": "X"}, {"id_no": "b", "tdata": "4"}]
    found = chart_points(measurements(spark, rows), limits(spark, [{}]))
    assert values(found, "id_no", "rcard", "mdate") == [("b", "X", at(1))]


def series(spark, numbers, **extra):
    return points(spark, [{"avgvalue": v, "rangevalue": 1.0, **extra} for v in numbers])


def fired(spark, numbers, rule, mode="monotone", slots=None):
    """Positions at which the rule fires on the value of an individual chart with centre 10 and limits 7..13."""
    flags = flag_rules(series(spark, numbers), limits(spark, [{}]), [rule], mode, slots)
    return [i for i, (flag,) in enumerate(values(flags, f"avg_{rule}")) if flag]


@pytest.mark.parametrize(
    "rule, numbers, want",
    [
        (1, [13.0, 13.001, 7.0, 6.999, None], [1, 3]),
        # Two thirds of the distance lie at 12 and 8; a value on the line is not beyond it.
        (2, [12.001, 10.0, 12.001], [2]),
        (2, [12.0, 10.0, 12.001], []),
        (2, [12.001, 10.0, 12.0], []),
        (2, [7.9, 10.0, 12.1], []),
        (2, [10.0, 7.9, 7.9], [2]),
        (2, [12.1, 12.1], []),
        (2, [None, 12.1, 12.1], []),
        (2, [None, 12.1, 10.0, 12.1], [3]),
        # One third: 11 and 9.
        (3, [11.1, 11.1, 11.1, 10.0, 11.1], [4]),
        (3, [11.1, 11.1, 10.0, 10.0, 11.1], []),
        (3, [11.1, 11.1, 11.1, 11.1, 11.0], []),
        (3, [8.9, 8.9, 11.1, 8.9, 8.9], [4]),
        (3, [11.1, 11.1, None, 11.1, 11.1], []),
        (4, [1, 2, 3, 4, 5, 6], [5]),
        (4, [6, 5, 4, 3, 2, 1], [5]),
        (4, [1, 2, 3, 3, 5, 6], []),
        (4, [1, 2, 3, 4, 5], []),
        (4, [1, None, 3, 4, 5, 6, 7, 8], [7]),
    ],
)
def test_rules_at_their_borders(spark, rule, numbers, want):
    numbers = [None if v is None else float(v) for v in numbers]
    assert fired(spark, numbers, rule) == want


def test_trend_in_compat_mode(spark):
    # The point is above the oldest of the five, which fall towards it.
    assert fired(spark, [5.0, 4.0, 3.0, 2.0, 1.0, 6.0], 4, "compat") == [5]
    assert fired(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 4, "compat") == []


def test_rules_over_slots_equal_rules_in_one_piece(spark):
    rng = random.Random(8)
    numbers = [None if rng.random() < 0.05 else round(rng.gauss(10, 2), 1) for _ in range(300)]
    for rule in (2, 3, 4):
        assert fired(spark, numbers, rule, slots=23) == fired(spark, numbers, rule, slots=1)
    centre = [abs(v - 10) > 2 and v for v in [x if x is not None else 10 for x in numbers]]
    want = [
        i
        for i in range(2, 300)
        if None not in numbers[i - 2 : i + 1]
        and any(
            centre[i] and centre[j] and (numbers[i] > 10) == (numbers[j] > 10) for j in (i - 1, i - 2)
        )
    ]
    assert fired(spark, numbers, 2, slots=23) == want


def test_judge_names_warnings_by_chart(spark):
    pts = points(
        spark,
        [
            {"factory": "F1", "avgvalue": 14.0, "rangevalue": 4.0},
            {"factory": "F3", "avgvalue": 14.0, "rangevalue": 4.0},
            {"factory": "F8", "avgvalue": 6.0, "stddevvalue": 4.0},
            {"factory": "F1", "avgvalue": 10.0, "rangevalue": 1.0},
            {"factory": "F1", "avgvalue": 10.0},
            {"factory": "F8", "avgvalue": 10.0, "rangevalue": 1.0},
        ],
    )
    lims = limits(
        spark,
        [
            {"factory": "F1"},
            {"factory": "F3", "pcs": 3},
            {"factory": "F8", "pcs": 8, "rangeucl": None, "rangelcl": None, "stddevucl": 2.0, "stddevlcl": 0.1},
        ],
    )
    assert values(judge(pts, lims), "factory", "spcwarn", "spcgraphtype") == [
        ("F1", "单值一, 极差一", "单值和移动极差图"),
        ("F3", "均值一, 极差一", "均值极差图"),
        ("F8", "均值一, 标准差一", "均值标准差图"),
        ("F1", "", "单值和移动极差图"),
    ]


def test_rules_two_and_three_are_for_individual_charts(spark):
    numbers = [12.1, 12.1, 12.1, 12.1, 12.1]
    single = judge(series(spark, numbers), limits(spark, [{}]))
    assert values(single, "spcwarn")[-1] == ("单值二, 单值三",)
    grouped = judge(series(spark, numbers), limits(spark, [{"pcs": 3}]))
    assert {v[0] for v in values(grouped, "spcwarn")} == {""}


def test_a_left_out_point_still_breaks_a_run(spark):
    rows = [{"avgvalue": float(v), "rangevalue": None if v == 3 else 1.0} for v in range(1, 9)]
    found = judge(points(spark, rows), limits(spark, [{}]), rules=[4])
    assert len(found.collect()) == 7
    # The value itself is there, so the value runs on; only the range is missing.
    assert [v[0] for v in values(found, "spcwarn")] == ["", "", "", "", "单值四", "单值四", "单值四"]


def test_incremental_judging_is_a_part_of_the_full_one(spark):
    rng = random.Random(4)
    pts = series(spark, [round(rng.gauss(10, 2), 1) for _ in range(120)])
    mark = F.lit(at(60)).cast("timestamp_ntz")
    lims = limits(spark, [{}])
    full = judge(pts, lims, rules=(1, 4)).filter(F.col("time") > mark)
    part = judge(pts, lims, rules=(1, 4), mark=mark)
    assert sorted(map(str, part.collect())) == sorted(map(str, full.collect())) and part.count() == 59


def test_incremental_judging_may_need_stddev_limits(spark):
    pts = points(spark, [{"avgvalue": 10.0, "stddevvalue": 1.0}])
    lims = limits(spark, [{"pcs": 8, "stddevucl": None, "stddevlcl": None}])
    assert judge(pts, lims, rules=(1, 4)).count() == 1
    assert judge(pts, lims, rules=(1, 4), need_stddev_limits=True).count() == 0
