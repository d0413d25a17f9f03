from datetime import datetime

from frames import limits, results
from pyspark.sql import functions as F

from shopgauge.operators.recheck import relimit
from shopgauge.schema import LIMIT_COLUMNS, LIMITS
from shopgauge.sources import store


def one(df, *columns):
    rows = df.select(*columns).collect()
    assert len(rows) == 1
    return tuple(rows[0])


def judged(spark, warned, total=25, **extra):
    rows = [{"testvalueavg": 10.0, "testvaluerange": 2.0, "spcwarn": "单值一" if i in warned else ""} for i in range(total)]
    return results(spark, [{**r, **extra} for r in rows])


def test_all_clean_keeps(spark):
    assert one(relimit(judged(spark, [])), "action", "clean_points", "avgucl") == ("keep", 25, None)


def test_fewer_than_25_points_are_not_checked(spark):
    assert relimit(judged(spark, [0], total=24)).count() == 0


def test_only_the_newest_25_count(spark):
    assert one(relimit(judged(spark, [0, 1], total=27)), "action") == ("keep",)
    assert one(relimit(judged(spark, [1], total=25)), "action") == ("update",)


def test_some_clean_gives_new_limits_from_plain_means(spark):
    rows = [
        {"testvalueavg": 100.0 if i == 7 else float(i % 2), "testvaluerange": 2.0, "spcwarn": "单值一" if i == 7 else ""}
        for i in range(25)
    ]
    want = (11 + 0) / 24
    found = one(relimit(results(spark, rows)), "action", "avgucl", "avglcl", "rangeucl", "rangelcl", "stddevucl")
    assert found == ("update", round(want + 5.32, 3), round(want - 5.32, 3), 6.534, 0.0, None)


def test_size_of_the_newest_point_is_used(spark):
    rows = [{"testvalueavg": 10.0, "testvaluerange": 2.0, "testvaluestdev": 1.0, "samplenum": 1} for _ in range(25)]
    rows[3]["spcwarn"], rows[24]["samplenum"] = "单值一", 6
    assert one(relimit(results(spark, rows)), "pcs", "avgucl", "rangeucl", "stddevucl") == (6, 11.287, None, 1.97)


def test_none_clean_deletes(spark):
    assert one(relimit(judged(spark, range(25))), "action") == ("delete",)


def test_plants_and_classes(spark):
    assert relimit(judged(spark, [1], factory="台虹厂")).count() == 0
    assert relimit(judged(spark, [1], factory="台虹厂"), excluded_plants=()).count() == 1
    assert one(relimit(judged(spark, [1], samplenum=3), classes=["individual"]), "action") == ("keep",)
    assert one(relimit(judged(spark, [1], samplenum=30)), "action") == ("keep",)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_recheck_without_warnings_changes_nothing(spark):
    lims = limits(spark, [{}, {"factory": "G"}, {"factory": None}])
    assert same(store.apply_recheck(lims, relimit(judged(spark, []))), lims)


def test_recheck_updates_and_deletes(spark):
    lims = limits(spark, [{}, {"factory": "G"}, {"factory": "H"}])
    decisions = relimit(judged(spark, [1]).unionByName(judged(spark, range(25), factory="G")))
    found = {r.factory: r for r in store.apply_recheck(lims, decisions).collect()}
    assert set(found) == {"F", "H"} and found["F"].avgucl == 15.32 and found["H"].avgucl == 13.0
    by_steps = store.delete_keys(
        store.update_limits(lims, decisions.filter("action = 'update'")), decisions.filter("action = 'delete'")
    )
    assert same(by_steps, store.apply_recheck(lims, decisions))


def test_upsert_replaces_by_key_and_is_idempotent(spark):
    old = limits(spark, [{}, {"factory": None}, {"factory": "G"}])
    later = {"time": datetime(2025, 1, 1), "avgucl": 99.0}
    new = limits(spark, [{"avgucl": 50.0}, later, {"factory": None, **later}, {"factory": "N"}])
    once = store.upsert(old, new)
    found = {r.factory: r.avgucl for r in once.collect()}
    assert found == {"F": 99.0, None: 99.0, "G": 13.0, "N": 13.0} and once.count() == 4
    assert same(store.upsert(once, new), once)


def test_update_touches_limit_columns_only(spark):
    lims = limits(spark, [{}, {"factory": "G"}])
    change = limits(spark, [{"factory": "G", "avgucl": None, "usl": 1.0, "pcs": 9}])
    row = store.update_limits(lims, change).filter("factory = 'G'").first()
    assert (row.avgucl, row.usl, row.pcs) == (None, 20.0, 1)
    assert store.update_limits(lims, change).columns == LIMITS.fieldNames()


def test_row_ids_tell_rows_apart_and_repeat(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), ("a", None)], "x string, y string")
    ids = [r.i for r in df.select(store.row_id(["x", "y"]).alias("i")).collect()]
    assert ids[0] == ids[3] and len(set(ids)) == 3
    assert df.select(store.random_row_id().alias("i")).distinct().count() == 4


def test_append_and_new_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("m", F.col("id") % 2)
    store.append(df, path, by=["m"])
    store.append(df, path, partitions=2, by=["m"])
    assert spark.read.parquet(path).count() == 20
    store.write_new(spark.read.parquet(path).limit(5), str(tmp_path / "t2"))
    assert spark.read.parquet(str(tmp_path / "t2")).count() == 5


def test_text_export(spark):
    lims = store.as_text(limits(spark, [{"avgucl": 1.5, "usl": None}]))
    row = lims.first()
    assert (row.avgucl, row.usl, row.time, row.pcs, row.rangelcl) == ("1.500", "", "2024-01-01 00:00:00", "1", "0.000")
    assert len(LIMIT_COLUMNS) == 6
