import math
import random
import statistics

import pytest
from frames import at, key_of, measurements
from pyspark.sql import functions as F

from shopgauge.functions.readings import null_text
from shopgauge.operators import fixed_values as fixed
from shopgauge.operators.limits import chart_class, chart_constants, control_limits, limit_columns, with_constants
from shopgauge.operators.subgroups import moving_range, parse_readings, process_sheets, sheet_stats, subgroup_stats
from shopgauge.schema import KEY, LIMIT_COLUMNS
from shopgauge.plans.limits import recoded_limits


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    "text, want",
    [
        ("1.5", [1.5]), ("-2", [-2.0]), ("+.5", [0.5]), ("5.", []), ("NG", []), ("", []), (None, []), ("1e3", []),
        ("1;2;x;3", [1.0, 2.0, 3.0]), (";", []), ("1;;2", [1.0, 2.0]), ("NG;", []), (" 1", []), ("7;", [7.0]), ("null", []),
    ],
)
def test_parse_readings(spark, text, want):
    found = parse_readings(measurements(spark, [{"tdata": text}]))
    assert [r.value for r in found.collect()] == want


def test_null_text(spark):
    df = spark.createDataFrame([("null",), ("",), ("  ",), (" null ",), (None,), (" a ",)], "x string")
    assert values(df, null_text(F.col("x"))) == [(None,)] * 5 + [("a",)]


def test_chart_class_and_constants(spark):
    sizes = spark.createDataFrame([(n,) for n in range(1, 28)], "n int")
    classes = dict(values(sizes, "n", chart_class(F.col("n"))))
    assert [classes[n] for n in (1, 2, 5, 6, 25, 26)] == ["individual", "mean_range", "mean_range"] + ["mean_stddev"] * 3
    assert with_constants(sizes, "n").count() == 25 and chart_constants(spark).count() == 25


def test_limits_of_every_size(spark):
    sizes = spark.createDataFrame([(n, 100.0, 2.0, 0.5) for n in range(1, 27)], "n int, x double, r double, s double")
    made = with_constants(sizes, "n").withColumns(limit_columns(F.col("n"), F.col("x"), F.col("r"), F.col("s")))
    found = {r["n"]: [r[c] for c in LIMIT_COLUMNS] for r in made.collect()}
    assert found[1] == [105.32, 94.68, 6.534, 0.0, None, None]
    assert found[2] == [103.76, 96.24, 6.534, 0.0, None, None]
    assert found[5] == [101.154, 98.846, 4.228, 0.0, None, None]
    # 0.6435 is a tie: half goes up.
    assert found[6] == [100.644, 99.357, None, None, 0.985, 0.015]
    assert found[25] == [100.303, 99.697, None, None, 0.718, 0.283]
    assert 26 not in found
    for n in range(6, 26):
        _, b4, b3 = fixed.A3_B4_B3[n]
        assert math.isclose(b4 + b3, 2.0)


def brute_limits(rows, n=30, take="oldest"):
    """Limits of one process by plain Python."""
    samples = {}
    for row in rows:
        found = [float(t) for t in (row["tdata"] or "").split(";") if t.replace(".", "", 1).isdigit()]
        sample = samples.setdefault((row["rcard"], row["id_no"]), {"v": [], "t": row["mdate"], "new": None})
        sample["t"] = max(sample["t"], row["mdate"])
        sample["v"] += found
        if found and (sample["new"] is None or row["mdate"] >= sample["new"][0]):
            sample["new"] = (row["mdate"], sum(found))
    ordered = sorted((s for s in samples.items() if s[1]["v"]), key=lambda s: (s[1]["t"], s[0][1], s[0][0]))
    for i, (_, s) in enumerate(ordered):
        s["r"] = max(s["v"]) - min(s["v"])
        if len(s["v"]) == 1:
            s["r"] = abs(s["v"][0] - ordered[i - 1][1]["new"][1]) if i else None
    taken = [s for _, s in (ordered[:n] if take == "oldest" else ordered[-n:])]
    if len(taken) < n:
        return None
    sizes = [len(s["v"]) for s in taken]
    pcs = min(set(sizes), key=lambda size: (-sizes.count(size), size))
    centre = sum(sum(s["v"]) for s in taken) / sum(sizes)
    ranges = [s["r"] for s in taken if s["r"] is not None]
    return pcs, centre, sum(ranges) / len(ranges), sum(statistics.pstdev(s["v"]) for s in taken) / n


@pytest.mark.parametrize("take", ["oldest", "newest"])
@pytest.mark.parametrize("size", [1, 3, 7])
def test_control_limits_against_brute_force(spark, take, size):
    rng = random.Random(size)
    rows = []
    for sheet in range(45):
        for k in range(size):
            text = "NG" if rng.random() < 0.1 else f"{rng.uniform(5, 15):.2f}"
            if rng.random() < 0.05:
                text = f"{text};{rng.uniform(5, 15):.2f};x"
            rows.append({"id_no": f"{sheet:03d}", "rcard": "R", "mdate": at(sheet * 10 + k), "tdata": text, "op_code": None})
    rng.shuffle(rows)
    pcs, centre, spread_range, spread_dev = brute_limits(rows, take=take)
    found = control_limits(measurements(spark, rows), take=take).collect()
    assert len(found) == 1 and found[0].pcs == pcs and found[0].op_code is None
    half = {1: 2.66 * spread_range}.get(pcs) or (
        fixed.A2_D4[pcs][0] * spread_range if pcs <= 5 else fixed.A3_B4_B3[pcs][0] * spread_dev
    )
    assert found[0].avgucl == pytest.approx(centre + half, abs=6e-4)
    assert found[0].avglcl == pytest.approx(centre - half, abs=6e-4)


def sheets(count, **extra):
    return [{"tdata": str(10 + i % 3), **extra} for i in range(count)]


def test_gates(spark):
    assert control_limits(measurements(spark, sheets(29))).count() == 0
    assert control_limits(measurements(spark, sheets(30))).count() == 1
    # 30 samples of 15 sheets: each sheet has two run cards.
    twice = [{"id_no": str(i // 2), "rcard": str(i % 2), "tdata": "1"} for i in range(30)]
    assert control_limits(measurements(spark, twice)).count() == 0
    # 30 sheets, one of them unusable.
    assert control_limits(measurements(spark, sheets(29) + [{"tdata": "NG"}])).count() == 0


def test_spec_gate_and_newest_spec(spark):
    none = measurements(spark, sheets(30, lower=None, upper=None))
    assert control_limits(none).count() == 0
    assert control_limits(none, require_spec=False).count() == 1
    # The newest row decides, also when it is unusable and its spec is NULL.
    newest = measurements(spark, sheets(30) + [{"tdata": "NG", "lower": None, "upper": 99.0}])
    assert values(control_limits(newest), "usl", "lsl") == [(99.0, None)]


def test_forced_size_and_mode_tie(spark):
    rows = sheets(15) + [{"tdata": "1;2"} for _ in range(15)]
    frame = measurements(spark, rows)
    assert values(control_limits(frame), "pcs") == [(1,)]
    rows = sheets(14) + [{"tdata": "1;2"} for _ in range(16)]
    assert values(control_limits(measurements(spark, rows)), "pcs") == [(2,)]
    assert values(control_limits(measurements(spark, rows), force_n=1), "pcs") == [(1,)]


def test_no_limits_above_25(spark):
    rows = [{"tdata": ";".join(["1", "2"] * 13)} for _ in range(30)]
    assert control_limits(measurements(spark, rows)).count() == 0


def test_moving_range_uses_the_newest_usable_row_of_the_sample_before(spark):
    rows = [
        {"id_no": "a", "tdata": "5"},
        {"id_no": "a", "tdata": "7"},
        {"id_no": "a", "tdata": "NG"},
        {"id_no": "b", "tdata": "9"},
        {"id_no": "c", "tdata": "1;2"},
        {"id_no": "d", "tdata": "10"},
    ]
    found = dict(values(moving_range(subgroup_stats(measurements(spark, rows)), slots=3), "id_no", "range"))
    assert found == {"a": 2.0, "b": 2.0, "c": 1.0, "d": 7.0}
    first = moving_range(subgroup_stats(measurements(spark, [{"tdata": "1"}])))
    assert values(first, "range") == [(None,)]


def test_sheet_stats_merge_run_cards(spark):
    rng = random.Random(3)
    rows = [{"id_no": str(i % 4), "rcard": f"C{i % 5}", "tdata": f"{rng.uniform(0, 100):.3f}"} for i in range(80)]
    found = {r.id_no: r for r in sheet_stats(measurements(spark, rows)).collect()}
    for sheet, row in found.items():
        own = [float(r["tdata"]) for r in rows if r["id_no"] == sheet]
        assert (row.n, row.low, row.high) == (len(own), min(own), max(own))
        assert row.total == pytest.approx(sum(own)) and row.deviation == pytest.approx(statistics.pstdev(own))
        assert row.rcard == next(r["rcard"] for r in rows if r["id_no"] == sheet)


def test_equal_readings_have_no_deviation(spark):
    rows = [{"id_no": "a", "rcard": str(i), "tdata": "0.1"} for i in range(7)]
    assert sheet_stats(measurements(spark, rows)).first().deviation == pytest.approx(0.0, abs=1e-7)


def test_keys_are_separate(spark):
    rows = sheets(30) + sheets(30, factory="G") + sheets(29, factory="H")
    found = control_limits(measurements(spark, rows))
    assert {r.factory for r in found.collect()} == {"F", "G"}
    assert process_sheets(measurements(spark, rows)).count() == 3
    assert len({key_of(r) for r in found.collect()}) == 2 and KEY == found.columns[:8]


def test_recode_collision_keeps_the_newer_limit_or_merges(spark):
    old = [{"sta_code": "WB02", "tdata": "1", "mdate": at(i)} for i in range(30)]
    new = [{"sta_code": "WB-01-0030", "tdata": "9", "mdate": at(100 + i)} for i in range(30)]
    rows = [{**r, "op_code": "WB", "workshop_code": "生产一区", "lower": None, "upper": None} for r in old + new]
    kept = recoded_limits(measurements(spark, rows))
    assert values(kept, "sta_code", "avgucl") == [("TC1WB-00002", 9.0)]
    merged = recoded_limits(measurements(spark, rows), recode_first=True)
    assert values(merged, "sta_code", "avgucl") == [("TC1WB-00002", 1.0)]
