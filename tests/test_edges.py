"""Rows that the derived tables do not have: NULL key parts, equal times, far dates, very long numbers, large means."""

from datetime import datetime
from statistics import pstdev

import pytest
from frames import at, limits, measurements, results
from pyspark.sql import functions as F

from shopgauge.functions.numbers import fixed3
from shopgauge.operators.limits import control_limits
from shopgauge.operators.points import chart_points
from shopgauge.operators.recheck import relimit
from shopgauge.operators.rules import judge
from shopgauge.operators.slots import SLOT, cut_points, with_slots
from shopgauge.operators.subgroups import moving_range, process_sheets, subgroup_stats
from shopgauge.schema import KEY
from shopgauge.sources.store import row_id


@pytest.mark.parametrize("part", ["factory", "eattribute1_1"])
def test_null_key_parts_stay_through_the_chain(spark, part):
    rows = measurements(spark, [{"tdata": str(9 + i % 3), part: None} for i in range(40)])
    found = control_limits(rows)
    points = chart_points(rows, found)
    judged = judge(points, found)
    assert found.count() == 1
    assert points.count() == 39 == judged.count()
    assert {r[part] for r in judged.collect()} == {None}


def test_recheck_without_a_plant(spark):
    warned = [{"factory": None, "spcwarn": "1" if i == 3 else "", "testvalueavg": 10.0, "testvaluerange": 1.0} for i in range(25)]
    assert [(r.factory, r.action) for r in relimit(results(spark, warned)).collect()] == [(None, "update")]
    excluded = [{**w, "factory": "台虹厂"} for w in warned]
    assert relimit(results(spark, excluded)).count() == 0


def test_equal_times_pick_the_same_row_in_any_order(spark):
    rows = [{"id": str(i), "mdate": at(0), "id_no": "1", "upper": float(i), "tdata": str(i)} for i in range(40)]
    for key in (lambda r: r["id"], lambda r: -int(r["id"]), lambda r: hash((r["id"], 3))):
        frame = measurements(spark, sorted(rows, key=key)).repartition(3)
        usl = process_sheets(frame).first()["usl"]
        newest = subgroup_stats(frame.withColumn("rcard", F.lit("R"))).first()["newest_row_sum"]
        assert usl == newest
        rows[0].setdefault("_seen", usl)
        assert rows[0]["_seen"] == usl


def test_far_dates_are_ordered(spark):
    rows = [{"mdate": datetime(y, 12, 31, 23, 59, 59, 999999), "upper": float(y)} for y in (2020, 9999, 1971)]
    assert process_sheets(measurements(spark, rows)).first()["usl"] == 9999.0


def test_a_very_long_number_does_not_end_the_job(spark):
    got = spark.range(1).select(fixed3(F.lit(float("9" * 34))).alias("a"), fixed3(F.lit(1.0005)).alias("b"), fixed3(F.lit(None).cast("double")).alias("c")).first()
    assert tuple(got) == (float("9" * 34), 1.001, None)
    rows = measurements(spark, [{"tdata": "9" * 34 if i == 5 else "10"} for i in range(40)])
    assert control_limits(rows).count() == 1


def test_deviation_of_sheets_with_large_means(spark):
    readings = [1e6 + 0.05 * ((i * 7) % 10 - 4.5) for i in range(100)]
    rows = [{"id_no": "S", "rcard": f"R{i % 10}", "tdata": repr(v)} for i, v in enumerate(readings)]
    point = chart_points(measurements(spark, rows), limits(spark, [{"pcs": 6}])).first()
    assert point.stddevvalue == pytest.approx(round(pstdev(readings), 3), abs=1e-9)


def test_row_ids_tell_values_apart(spark):
    frame = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), ("1:a", "b"), ("1", "a:b")], "x string, y string")
    assert frame.select(row_id(["x", "y"])).distinct().count() == 6


def test_moving_range_over_several_slots(spark):
    rows = [{"tdata": str((i * 13) % 29), "sta_code": "S" if i % 4 else "T"} for i in range(80)]
    stats = subgroup_stats(measurements(spark, rows))
    one, many = (sorted(map(str, moving_range(stats, slots).select(*KEY, "id_no", "range").collect())) for slots in (1, 5))
    assert one == many
    assert with_slots(stats, KEY, "mdate", cut_points(stats, KEY, "mdate", 5)).select(SLOT).distinct().count() > 1
