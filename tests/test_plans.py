"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest
from frames import limits, measurements, points, results
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.dataframe import DataFrame

import shopgauge.operators.keyed as keyed_module
import shopgauge.operators.limits as limits_module
from shopgauge.operators.capability import capability, day_moments
from shopgauge.operators.limits import control_limits
from shopgauge.operators.lookups import map_workshop, recode_station
from shopgauge.operators.points import chart_points
from shopgauge.operators.rules import judge
from shopgauge.operators.slots import cut_points
from shopgauge.operators.subgroups import subgroup_stats
from shopgauge.plans.catalog import QUERIES
from shopgauge.plans.clean import clean_inspections
from shopgauge.plans.limits import scoped
from shopgauge.plans.stream import JudgedStream
from shopgauge.schema import RESULTS
from shopgauge.sources import store
from shopgauge.sources.kept import Batches
from shopgauge.sources.shared import pinned, work_folder
from shopgauge.sources.tables import load

PACKAGE = Path(__file__).resolve().parent.parent / "shopgauge"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    return pinned(measurements(spark, [{"tdata": str(i % 7)} for i in range(40)]))


def test_limits_plan(spark, rows):
    plan = plan_of(control_limits(rows))
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2
    for bad in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert bad not in plan


def test_sample_statistics_need_one_exchange(spark, rows):
    plan = plan_of(subgroup_stats(rows))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2


def test_capability_shuffles_days_after_readings(spark, rows):
    """One exchange for the readings, summed up to days in the map tasks, and one for the days."""
    plan = plan_of(capability(rows, "month"))
    assert plan.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in plan
    assert plan_of(capability(day_moments(rows), "month")).count("Exchange hashpartitioning") == 2


def checkpoints(monkeypatch, build):
    """How many checkpoints building a frame takes, and the frame."""
    calls = []
    checkpoint = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **b: calls.append(1) or checkpoint(self, *a, **b))
    return build(), len(calls)


SMALL = "/root/testdata/sf0.001"


def test_judging_pins_the_sample_states_only(spark, monkeypatch):
    _, times = checkpoints(monkeypatch, lambda: QUERIES["judge_full"](spark, SMALL))
    assert times == 1
    for name in ("rank_newest", "rank_oldest", "moving_range"):
        _, times = checkpoints(monkeypatch, lambda: QUERIES[name](spark, SMALL))
        assert times == 0


def test_limits_read_the_facts_once(spark, monkeypatch):
    """The scan lies before the pinned states; after them there is none."""
    read = []
    pinned_states = limits_module.pinned
    monkeypatch.setattr(limits_module, "pinned", lambda df: read.append(plan_of(df)) or pinned_states(df))
    plan = plan_of(QUERIES["limits_recode"](spark, SMALL))
    assert len(read) == 1 and read[0].count("FileScan") == 1 and read[0].count("Exchange hashpartitioning") == 1
    assert "FileScan" not in plan


def test_merge_is_one_full_join(spark):
    """One exchange picks the last change of each key, and each side goes to the join by one."""
    lims = pinned(limits(spark, [{}, {"factory": None}]))
    plan = plan_of(store.merge(lims, lims.withColumn("action", F.lit("upsert"))))
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("FullOuter") == 1


def test_one_source_is_pruned(spark, tmp_path):
    schema = T.StructType([*RESULTS.fields, T.StructField("datasource", T.StringType())])
    kept = Batches(spark, str(tmp_path / "r"), schema, by=["datasource"])
    kept.commit(results(spark, [{}, {}]).withColumn("datasource", F.lit("a")), "1")
    kept.commit(results(spark, [{}]).withColumn("datasource", F.lit("b")), "2")
    chosen = scoped(kept.read(), datasource="b")
    assert chosen.count() == 1 and kept.read().count() == 3
    assert re.search(r"PartitionFilters: \[[^\]]*datasource#\d+ = b", plan_of(chosen))


def test_bound_of_the_next_period_reaches_the_scan(spark):
    """The bound is a scalar of the scan's own filter, with no cast around it: the scan puts its value in place before it reads."""
    for name in ("next_period_slice", "next_month_slice"):
        scan = re.search(r"FileScan parquet \[l_orderkey.*", plan_of(QUERIES[name](spark, SMALL))).group(0)
        assert re.search(r"DataFilters: \[[^\]]*l_shipdate#\d+ >= Subquery", scan), scan


def test_lookups_do_not_shuffle(spark, rows):
    plan = plan_of(recode_station(map_workshop(rows)))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def test_windows_run_by_slot(spark, rows):
    lims = limits(spark, [{}])
    for frame in (chart_points(rows, lims), judge(points(spark, [{"avgvalue": 1.0, "rangevalue": 1.0}]), lims)):
        plan = plan_of(frame)
        assert "_slot" in re.search(r"Window \[lag.*", plan).group(0)
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = load(spark, "/root/testdata/sf0.001", "orders").filter("o_orderkey > 5").select("o_custkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in plan
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", plan)



def test_named_view(spark):
    load(spark, "/root/testdata/sf0.001", "region", view="plants")
    assert spark.sql("SELECT count(*) AS n FROM plants").first().n == 5


def test_work_folder_is_in_the_shared_place(spark):
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark) != work_folder(spark)


def test_no_row_leaves_spark_inside_the_package():
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:  # fits bounded models on the driver; its own tests cover it
            continue
        source = path.read_text()
        for call in (".collect(", ".toPandas(", ".first(", ".take(", ".rdd.map", "udf(", "InPandas", "crossJoin", "localCheckpoint"):
            assert call not in source, (path, call)


def test_inspection_tasks_hold_a_bounded_number_of_rows(spark):
    """However few partitions the session asks for, join and row ids get as many as the rows need."""
    header = spark.range(300).select(
        "id", F.lit("SMT").alias("workshop_code"), *[F.lit("x").alias(c) for c in ("mdate", "first_time", "rcard", "part_spec", "pixel", "op_code", "sta_code", "eattribute1", "result")]
    )
    detail = spark.range(6000).select((F.col("id") % 310).alias("id_no"), F.lit("a").alias("testitem"), F.lit(0.0).alias("lower"), F.lit(1.0).alias("upper"), (F.col("id") % 3).cast("string").alias("tdata"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        found = clean_inspections(header, detail, task_rows=200)
        largest = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        ids = {r.id for r in found.select("id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert largest < 1000
    assert len(ids) == detail.filter("id_no < 300").count()
    assert ids == {r.id for r in clean_inspections(header, detail).select("id").collect()}


def test_stream_of_batches_ranks_the_events_once(spark, monkeypatch):
    """The batches come from written measurements, and one set of slots serves both looks back."""
    read = []
    run = JudgedStream.run
    monkeypatch.setattr(JudgedStream, "run", lambda self, name, rows, *a: read.append(rows.inputFiles()) or run(self, name, rows, *a))
    cut = []
    monkeypatch.setattr(keyed_module, "cut_points", lambda *a, **b: cut.append(1) or cut_points(*a, **b))
    QUERIES["judge_stream_of_batches"](spark, SMALL)
    assert len(read) == 6 and not any("events" in f for files in read for f in files)
    # That of the fixture's ranks.
    assert len(cut) == 1
