import random

import pytest
from frames import at
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.operators.keyed import first_n, join_same, latest_per_key, look_back, ranked
from shopgauge.operators.slots import SLOT, cut_points, with_slots


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, with many equal times; another key is NULL."""
    rng = random.Random(5)
    keys = ["hot"] * 400 + [None] * 60 + [f"k{i % 150}" for i in range(740)]
    rows = [(k, at(rng.randrange(90)), f"{i:05d}", rng.random()) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, id string, v double")


def rows_of(df, *columns):
    return sorted(df.select(*columns).collect(), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_slots_split_the_hot_key_evenly(spark, skewed):
    slots = with_slots(skewed, ["k"], "t", cut_points(skewed, ["k"], "t", 12))
    sizes = {(r.k, r[SLOT]): r["count"] for r in slots.groupBy("k", SLOT).count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    # A slot holds a twelfth of the rows and those of one more second at most.
    most = skewed.filter("k = 'hot'").groupBy("t").count().agg(F.max("count")).first()[0]
    assert len(hot) >= 4 and max(hot) <= 100 + most
    assert all(slot == 0 for k, slot in sizes if k not in ("hot", None))
    assert cut_points(skewed, ["k"], "t").count() == 0


def test_slots_follow_from_the_rows_alone(skewed):
    def slots(df):
        return sorted(map(str, with_slots(df, ["k"], "t", cut_points(df, ["k"], "t", 9)).collect()))

    assert slots(skewed) == slots(skewed.repartition(7)) == slots(skewed.coalesce(1))


def test_many_slots_of_one_key(spark):
    """More slots than a chunk of cuts holds, NULL times first, numbers before and after each slot."""
    rows = spark.createDataFrame([("a", None if i < 5 else at(i), i) for i in range(700)], "k string, t timestamp_ntz, i int")
    found = with_slots(rows, ["k"], "t", cut_points(rows, ["k"], "t", 350), sizes=True).orderBy("i").collect()
    slots = [r[SLOT] for r in found]
    assert slots == sorted(slots) and slots[-1] > 300 and slots[:5] == [0] * 5
    for r in found:
        assert r["_before"] == sum(s < r[SLOT] for s in slots) and r["_after"] == sum(s > r[SLOT] for s in slots)


@pytest.mark.parametrize("kind", ["date", "long", "double", "timestamp"])
def test_slots_by_other_kinds_of_time(spark, kind):
    time = {"date": "date_add(DATE'2024-01-01', int(id / 3))", "long": "id", "double": "id / 7", "timestamp": "timestamp_seconds(id)"}[kind]
    rows = spark.range(300).selectExpr("'a' AS k", f"{time} AS t", "id")
    found = ranked(rows, ["k"], ["t", "id"], slots=6).orderBy("id").collect()
    assert [r.num for r in found] == list(range(1, 301))
    with pytest.raises(TypeError):
        cut_points(rows.withColumn("t", F.lit("x")), ["k"], "t")


def test_nothing_is_pinned_and_small_tables_are_not_split(skewed):
    for frame in (ranked(skewed, ["k"], ["t", "id"]), look_back(skewed, ["k"], ["t", "id"], 1, lambda w: {"b": F.lag("v").over(w)})):
        plan = plan_of(frame)
        assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("slots", [None, 1, 7, 40])
@pytest.mark.parametrize("depth", [1, 5])
def test_look_back_equals_plain_window(skewed, slots, depth):
    def lags(window):
        return {f"b{i}": F.lag("v", i).over(window) for i in range(1, depth + 1)}

    plain = skewed.withColumns(lags(W.partitionBy("k").orderBy("t", "id")))
    names = ["k", "id", *lags(W.partitionBy("k").orderBy("t", "id"))]
    assert rows_of(look_back(skewed, ["k"], ["t", "id"], depth, lags, slots), *names) == rows_of(plain, *names)


def test_look_back_over_slots_smaller_than_the_depth(spark):
    rows = spark.createDataFrame([("a", at(i), f"{i:03d}", float(i)) for i in range(30)], "k string, t timestamp_ntz, id string, v double")
    found = look_back(rows, ["k"], ["t", "id"], 5, lambda w: {"b5": F.lag("v", 5).over(w)}, slots=15)
    assert [(r.v, r.b5) for r in found.orderBy("v").collect()] == [(float(i), float(i - 5) if i >= 5 else None) for i in range(30)]


@pytest.mark.parametrize("slots", [None, 9])
@pytest.mark.parametrize("newest", [True, False])
def test_ranked_equals_row_number(skewed, slots, newest):
    order = [F.desc(c) if newest else F.asc(c) for c in ("t", "id")]
    plain = skewed.withColumn("num", F.row_number().over(W.partitionBy("k").orderBy(*order)).cast("long"))
    found = ranked(skewed, ["k"], ["t", "id"], newest_first=newest, slots=slots)
    assert rows_of(found, "k", "id", "num") == rows_of(plain, "k", "id", "num")


def test_first_n_cuts_before_the_shuffle(skewed):
    plan = first_n(skewed, ["k"], [F.asc("t"), F.asc("id")], 3)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_join_same_matches_null(spark):
    left = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, m string, v int")
    right = spark.createDataFrame([("a", None, 10), ("b", "y", 20)], "k string, m string, w int")
    assert [tuple(r) for r in join_same(left, right, ["k", "m"]).collect()] == [("a", None, 1, 10)]


def test_latest_per_key_keeps_whole_rows(spark):
    rows = [("a", 1, "old", None), ("a", 2, None, "new"), (None, 5, "n", "n")]
    df = spark.createDataFrame(rows, "k string, t int, x string, y string")
    assert rows_of(latest_per_key(df, ["k"], ["t"]), "*") == sorted(
        df.filter("t != 1").collect(), key=str
    )
