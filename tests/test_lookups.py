from collections import Counter

import pytest
from frames import measurements
from pyspark.sql import functions as F

from shopgauge.operators import fixed_values as fixed
from shopgauge.operators import lookups
from shopgauge.plans.limits import relocated_limits
from shopgauge.schema import MEASUREMENTS
from shopgauge.sources.tables import typed


def mapped(spark, function, names, *columns):
    df = spark.createDataFrame([(n,) if isinstance(n, str) or n is None else n for n in names], "workshop_code string, c string" if isinstance(names[0], tuple) else "workshop_code string")
    return [tuple(r) for r in function(df).select(*(columns or ("workshop_code", "factory"))).collect()]


def test_sizes_of_the_maps(spark):
    assert lookups.charted_pairs(spark).count() == 60
    assert lookups.charted_pairs(spark).select("op_code").distinct().count() == 8
    assert len(fixed.SECOND_SOURCE_PLANTS) == 18
    stations = Counter(r["_workshop"] for r in lookups.station_map(spark).select("_workshop", "_new").distinct().collect())
    assert stations == {
        "生产一区": 32, "生产二区": 36, "生产三区": 45, "生产六区": 39, "生产七区": 77, "生产四区": 61, "古城COB一区": 126,
    }
    assert lookups.station_map(spark, ["生产一区"]).count() == 64 and lookups.move_map(spark).count() == 122


def test_workshop_map(spark):
    assert mapped(spark, lookups.map_workshop, ["生产一区", "古城COB二区", "3D区", "古二试产二区", "古城试产一区", "外面", None]) == [
        ("台虹COB一区", "台虹厂"),
        ("古一COB一区", "古城一厂"),
        ("3D区", "台虹厂"),
        ("古二试产二区", "古城二厂"),
        ("古城试产一区", None),
        ("外面", None),
        (None, None),
    ]


def test_workshop_map_by_class(spark):
    rows = [
        ("生产四区", "十级"), ("生产四区", "COB"), ("生产四区", "千级"), ("生产四区", "测试"), ("生产四区", "别的"),
        ("生产四区", None), ("生产五区", "千级"), ("古城试产一区", None), ("外面", "十级"),
    ]
    assert mapped(spark, lambda df: lookups.map_workshop_by_class(df, "workshop_code", "c"), rows) == [
        ("古二COB二区", "古城二厂"), ("古二COB二区", "古城二厂"), ("古二测试三区", "古城二厂"), ("古二测试三区", "古城二厂"),
        (None, "古城二厂"), (None, "古城二厂"), ("古二COB二区", "古城二厂"), ("古一试产一区", "古城一厂"), ("外面", None),
    ]


def test_final_qc_and_second_source_maps(spark):
    assert mapped(spark, lookups.map_workshop_final_qc, ["生产一区", "生产五区", "古城试产一区", "外面"]) == [
        ("台虹测试一区", "台虹厂"), ("古二COB二区", "古城二厂"), ("古一试产一区", "古城一厂"), ("外面", None),
    ]
    assert mapped(spark, lookups.map_second_source_plant, ["生产八区", "古城后段三区", "外面"]) == [
        ("生产八区", "汉浦厂"), ("古城后段三区", "古城厂"), ("外面", None),
    ]


STATIONS = [
    ("生产一区", "x", "WB02", "TC1WB-00002"),
    ("生产一区", None, "WB-01-0030", "TC1WB-00002"),
    ("生产一区", "x", "WB17", "WB17"),
    ("生产二区", "x", "WB40", "TC2WB-00040"),
    ("生产二区", "x", "WB09", "WB09"),
    ("生产三区", "x", "WB14", "WB14"),
    ("生产三区", "x", "WB15", "TC3WB-03002"),
    ("生产三区", "x", "WB37", "TC3WB-04005"),
    ("生产三区", "x", "WB44", "TC3WB-04006"),
    ("生产三区", "x", "WB43", "TC3WB-04007"),
    ("生产六区", "x", "WB39", "TC6WB-05007"),
    ("生产七区", "x", "WB22", "TC7WB-04001"),
    ("生产七区", "x", "WB77", "TC7WB-10008"),
    ("生产四区", "汉浦厂", "WB61", "HC4WB-00061"),
    ("生产四区", "汉浦厂", "WB-03-0107", "HC4WB-00061"),
    ("生产四区", "汉浦厂", "WB-03-0211", "HC4WB-00038"),
    ("生产四区", "x", "WB61", "WB61"),
    ("古城COB一区", "古城厂", "WB018", "GC1WB-01008"),
    ("古城COB一区", "古城厂", "WB047", "WB047"),
    ("古城COB一区", "古城厂", "WB196", "GC1WB-19006"),
    ("外面", "x", "WB02", "WB02"),
    (None, "x", "WB02", "WB02"),
]


def test_station_codes(spark):
    df = spark.createDataFrame([(i, *s[:3]) for i, s in enumerate(STATIONS)], "i int, workshop_code string, factory string, sta_code string")
    found = lookups.recode_station(df).orderBy("i").collect()
    assert [r.sta_code for r in found] == [s[3] for s in STATIONS]


@pytest.mark.parametrize(
    "old, new",
    [
        ("WB01", "GC2WB-19001"), ("WB-03-0231", "GC2WB-19006"), ("WB07", "HC4WB-00007"), ("WB38", "GC2WB-20001"),
        ("WB44", "GC2WB-11001"), ("WB56", "GC2WB-11007"), ("WB-03-0267", "GC2WB-11007"), ("WB57", "GC2WB-12007"),
        ("WB55", "GC2WB-12006"), ("WB58", "HC4WB-00058"),
    ],
)
def test_moved_stations(spark, old, new):
    assert {r["_old"]: r["_new"] for r in lookups.move_map(spark).collect()}[old] == new


def test_relocated_limits(spark):
    rows = [{"tdata": "1", "op_code": "WB", "workshop_code": "生产四区", "factory": "汉浦厂", "sta_code": s} for s in ("WB44", "X1") for _ in range(30)]
    rows += [{"tdata": "1", "op_code": "DB", "workshop_code": "生产四区", "factory": "汉浦厂", "sta_code": "WB44"} for _ in range(30)]
    found = relocated_limits(measurements(spark, rows)).select("workshop_code", "factory", "sta_code").collect()
    assert sorted(map(tuple, found)) == [("古二COB二区", "古城厂", "GC2WB-11001"), ("生产四区", "汉浦厂", "X1")]


def test_items(spark):
    rows = [("WB", "Stich  Pull"), ("WB", "Stich Pull"), ("锁付", "锁付扭力"), ("DB", "锁付扭力"), (None, "浮高Z"), ("AA", None)]
    df = spark.createDataFrame(rows, "op_code string, testitem string")
    kept = [tuple(r) for r in lookups.keep_charted(df).select("op_code", "testitem").collect()]
    assert kept == [rows[0], rows[2]]
    assert lookups.keep_charted(df).count() + lookups.reject_uncharted(df).count() == len(rows)


def test_sections(spark):
    df = spark.createDataFrame([("十级",), ("千级",), ("COB",), ("",)], "c string")
    assert [r.s for r in df.select(lookups.section_of(F.col("c")).alias("s")).collect()] == ["COB", "测试", "", ""]


def test_typed_text_tables(spark):
    names = MEASUREMENTS.fieldNames()
    row = {n: "null" for n in names} | {"mdate": "2024-01-01 10:00:00", "lower": "", "upper": "12.5", "tdata": " 5 ", "op_code": "x"}
    bad = {n: " " for n in names} | {"mdate": "soon", "lower": "1,5"}
    raw = spark.createDataFrame([tuple(r[n] for n in names) for r in (row, bad)], ", ".join(f"{n} string" for n in names))
    good, wrong = typed(raw, MEASUREMENTS).collect()
    assert (str(good.mdate), good.lower, good.upper, good.tdata, good.op_code, good.factory) == ("2024-01-01 10:00:00", None, 12.5, "5", "x", None)
    assert set(wrong) == {None}
