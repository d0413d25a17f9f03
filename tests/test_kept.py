"""States that are merged, tables that grow by batches or are replaced by versions, and row ids."""

import random

import pytest
from frames import at, limits, measurements, results
from pyspark.sql import functions as F

from shopgauge.functions.ids import with_row_ids
from shopgauge.operators.capability import capability, day_moments, finished
from shopgauge.operators.limits import control_limits
from shopgauge.operators.points import chart_points
from shopgauge.operators.recheck import relimit
from shopgauge.operators.rules import judge
from shopgauge.operators.subgroups import merge_states, sample_states
from shopgauge.plans.stream import JudgedStream
from shopgauge.schema import DAY_MOMENTS, KEY, LIMIT_COLUMNS, LIMITS, RESULTS, SAMPLE_STATES
from shopgauge.sources import store
from shopgauge.sources.kept import Batches, Versions
from shopgauge.sources.shared import pinned


def rows_of(df, *drop):
    """Rows in any order, numbers to four decimals; the readings have three, so the small addition keeps sums off the border."""
    def cell(v):
        return f"{v + 3.3e-6:.4f}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df.drop(*drop).collect())


@pytest.fixture(scope="module")
def many(spark):
    """Three processes (one with a NULL plant), sheets of several cards and sizes, junk, large means, sheets that last for days."""
    rng = random.Random(3)
    rows = []
    for op, size, plant in (("A", 1, "F"), ("B", 3, None), ("C", 8, "F")):
        for sheet in range(45):
            begin = sheet * 600 + rng.randrange(60)
            for k in range(size + rng.randrange(2)):
                text = rng.choice(["NG", "1e6", None]) if rng.random() < 0.05 else ";".join(f"{1000 + rng.gauss(0, 2):.3f}" for _ in range(rng.choice([1, 1, 2])))
                rows.append({"op_code": op, "factory": plant, "id_no": f"{sheet:03d}", "rcard": f"R{k % 2}", "mdate": at(begin + k * 40), "tdata": text, "upper": rng.choice([1010.0, 1011.0, None])})
    rng.shuffle(rows)
    return pinned(measurements(spark, [{**r, "id": str(i)} for i, r in enumerate(rows)]).coalesce(2))


def parts_of(df, n):
    return [df.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == k) for k in range(n)]


def test_states_merge_to_the_state_of_all_rows(many):
    whole = sample_states(many)
    first, second, third = (sample_states(p) for p in parts_of(many, 3))
    merged = merge_states(first.unionByName(second).unionByName(third))
    again = merge_states(merge_states(first.unionByName(second)).unionByName(third))
    assert rows_of(whole.select(merged.columns)) == rows_of(merged) == rows_of(again)
    assert whole.select(SAMPLE_STATES.fieldNames()).schema.simpleString() == SAMPLE_STATES.simpleString()


def test_limits_and_points_from_merged_states(spark, many):
    merged = merge_states(sample_states(many.filter("id < 300")).unionByName(sample_states(many.filter("id >= 300"))))
    time = F.lit("2024-01-01").cast("timestamp_ntz")
    want = control_limits(many, time)
    assert want.count() == 3
    assert rows_of(control_limits(merged, time)) == rows_of(want)
    assert rows_of(chart_points(merged, want)) == rows_of(chart_points(many, want))
    assert chart_points(many, want).select("id").distinct().count() == chart_points(many, want).count()


def test_days_merge_to_periods(spark, many):
    days = [day_moments(p) for p in parts_of(many, 3)]
    assert rows_of(capability(days[0].unionByName(days[1]).unionByName(days[2]), "week")) == rows_of(capability(many, "week"))
    assert day_moments(many).schema.simpleString() == DAY_MOMENTS.simpleString()


def test_finished_periods_only(spark, many):
    def weeks(*bounds):
        found = finished(day_moments(many), "week", *[F.lit(b).cast("date") for b in bounds])
        return {str(r.w) for r in found.select(F.trunc("day", "WEEK").alias("w")).distinct().collect()}

    everything = weeks("2100-01-01")
    assert weeks("2024-01-08") == {"2024-01-01"} and weeks("2024-01-07") == set()
    assert weeks("2024-01-15") - weeks("2024-01-15", "2024-01-01") == {"2024-01-01"}
    assert weeks("2100-01-01", "2024-01-08") == everything - {"2024-01-01", "2024-01-08"}


def test_batches_are_written_once_and_whole(spark, tmp_path):
    kept = Batches(spark, str(tmp_path / "b"), LIMITS)
    assert kept.read().count() == 0 and kept.read().columns == LIMITS.fieldNames()
    assert kept.commit(limits(spark, [{}, {"factory": "G"}]), "one")
    assert not kept.commit(limits(spark, [{}]), "one")
    assert kept.commit(limits(spark, [{"factory": "H"}]), "two", partitions=1)
    assert kept.read().count() == 3
    # A batch that was cut off does not count and is written anew.
    (tmp_path / "b" / "batch=two" / "_SUCCESS").unlink()
    assert kept.read().count() == 2 and not kept.has("two")
    assert kept.commit(limits(spark, [{"factory": "H"}, {"factory": "I"}]), "two")
    assert kept.read().count() == 4
    assert spark.range(1).select(kept.mark("time", F.lit("1999-01-01").cast("timestamp_ntz")).alias("m")).first().m == at(0)


def test_versions_replace_and_survive_a_killed_run(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "v"), LIMITS)
    assert table.read().count() == 0
    assert table.write(limits(spark, [{}]), "a") and not table.write(limits(spark, [{}, {}]), "a")
    assert table.write(table.read().unionByName(limits(spark, [{"factory": "G"}])), "b")
    assert (table.read().count(), table.names()) == (2, ["a", "b"])
    old = table.read()
    assert table.write(limits(spark, []), "c") and table.read().count() == 0 and table.names() == ["b", "c"]
    assert old.count() == 2
    next((tmp_path / "v").glob("version=*-c/_SUCCESS")).unlink()
    assert table.read().count() == 2
    assert table.write(limits(spark, [{}]), "c") and table.read().count() == 1


def test_merge_against_changes_one_by_one(spark):
    rng = random.Random(5)
    plants = ["F", None, "G", "H", "I", "J"]
    for _ in range(4):
        old = {p: {"factory": p, "pcs": 1, "avgucl": 1.0, "usl": 2.0} for p in rng.sample(plants, 4)}
        changes = [
            {"factory": rng.choice(plants), "time": at(i), "pcs": i, "avgucl": rng.choice([None, float(i)]), "usl": float(i), "action": rng.choice(["upsert", "update", "delete"])}
            for i in range(8)
        ]
        last = {c["factory"]: c for c in changes}
        want = dict(old)
        for p, c in last.items():
            if c["action"] == "delete":
                want.pop(p, None)
            elif c["action"] == "upsert":
                want[p] = c
            elif p in want:
                want[p] = {**want[p], "avgucl": c["avgucl"]}
        tagged = None
        for c in changes:
            row = limits(spark, [{k: v for k, v in c.items() if k != "action"}]).withColumn("action", F.lit(c["action"]))
            tagged = row if tagged is None else tagged.unionByName(row)
        found = store.merge(limits(spark, list(old.values())), tagged)
        assert found.columns == LIMITS.fieldNames()
        assert {r.factory: (r.pcs, r.avgucl, r.usl) for r in found.collect()} == {p: (r["pcs"], r["avgucl"], r["usl"]) for p, r in want.items()}


def test_repeated_changes_do_not_multiply_rows(spark):
    lims = limits(spark, [{}, {"factory": "G"}])
    twice = limits(spark, [{"avgucl": 50.0}, {"avgucl": 60.0, "time": at(5)}])
    assert sorted(r.avgucl for r in store.update_limits(lims, twice).collect()) == [13.0, 60.0]
    decisions = twice.withColumn("action", F.lit("update")).drop("time")
    assert store.apply_recheck(lims, decisions).count() == 2


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_equal_rows_get_different_ids(spark, chunk):
    rows = [("a", 1, None)] * 40 + [("a", None, 1)] * 3 + [("b", 2, 2)]
    df = spark.createDataFrame(rows, "x string, y int, `z z` int").repartition(4)
    found = with_row_ids(df, chunk=chunk)
    assert found.columns == ["id", "x", "y", "z z"] and found.count() == 44 == found.select("id").distinct().count()
    assert rows_of(found.drop("id")) == rows_of(df)
    assert rows_of(found) == rows_of(with_row_ids(df.coalesce(1)))
    assert with_row_ids(df.limit(0)).count() == 0


def stream_of(spark, folder, rows, lims, cuts, hold, **options):
    stream = JudgedStream(spark, folder, **options)
    low = None
    for number, end in enumerate([*cuts, None]):
        part = rows if low is None else rows.filter(F.col("mdate") > low)
        if end is not None:
            low = F.lit(at(end)).cast("timestamp_ntz")
            part = part.filter(F.col("mdate") <= low)
        close = None if end is None else F.lit(at(end - hold)).cast("timestamp_ntz")
        assert stream.run(f"b{number}", part, lims, close)
        assert not stream.run(f"b{number}", part, lims, close)
    return stream


def test_batches_are_judged_as_the_whole(spark, many, tmp_path):
    """Borders lie within sheets, and one batch closes nothing."""
    rules = (1, 2, 3, 4)
    lims = pinned(control_limits(many, F.lit("2024-01-01").cast("timestamp_ntz")))
    whole = judge(chart_points(many, lims), lims, rules)
    stream = stream_of(spark, str(tmp_path), many, lims, [9000, 9010, 20_000], 500, rules=rules)
    assert whole.count() > 70
    assert rows_of(stream.results.read()) == rows_of(whole)
    left = stream.state.read()
    assert left.filter("not closed").count() == 0
    assert left.groupBy(*KEY).count().agg(F.max("count")).first()[0] == 6


def test_a_batch_that_was_cut_off_is_done_anew(spark, many, tmp_path):
    lims = pinned(control_limits(many, F.lit("2024-01-01").cast("timestamp_ntz")))
    stream = stream_of(spark, str(tmp_path), many.filter("mdate <= timestamp_ntz'2024-01-05'"), lims, [], 0)
    for marker in tmp_path.glob("state/version=*/_SUCCESS"):
        marker.unlink()
    assert stream.state.read().count() == 0
    assert stream.run("b0", many.filter("mdate <= timestamp_ntz'2024-01-05'"), lims)
    assert stream.run("b1", many.filter("mdate > timestamp_ntz'2024-01-05'"), lims)
    read = stream.results.read()
    assert read.count() == read.select("id").distinct().count()
    assert not stream.run("b1", many, lims)


def test_results_by_source(spark, tmp_path):
    kept = Batches(spark, str(tmp_path), RESULTS)
    kept.commit(results(spark, [{"testvalueavg": 1.0, "testvaluerange": 1.0, "spcwarn": "x" if i == 3 else ""} for i in range(25)]), "one")
    assert [r.action for r in relimit(kept.read()).collect()] == ["update"]
    assert len(LIMIT_COLUMNS) == 6
