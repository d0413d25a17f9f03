"""Queries over the test tables, one per operator or job."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.functions.dates import day_text
from shopgauge.functions.numbers import fixed3
from shopgauge.functions.readings import null_text
from shopgauge.operators import capability as cpk
from shopgauge.operators import limits as lim
from shopgauge.operators import lookups, periods, points, recheck, rules, slices, subgroups
from shopgauge.operators.keyed import ranked
from shopgauge.operators.slots import cut_points
from shopgauge.plans import clean
from shopgauge.plans.limits import patrols, recoded_limits, relocated_limits, scoped
from shopgauge.plans.stream import JudgedStream
from shopgauge.schema import DAY_MOMENTS, KEY, LIMITS, MEASUREMENTS, POINTS, RESULTS, SAMPLE_STATES, capability_schema
from shopgauge.sources import fixtures, store
from shopgauge.sources.kept import Batches, Versions
from shopgauge.sources.shared import pinned, work_folder
from shopgauge.sources.tables import load, typed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIME = "2024-02-01 00:00:00"
MARK = "2024-01-20 00:00:00"
# Enough slots that every process of `insp` is cut.
SLOTS = 40
# Processes of `insp` differ in the operation, which tells their plants too.
SHEET = ["op_code", "id_no"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _patrols(spark, folder):
    return patrols(fixtures.insp(spark, folder))


def _states(spark, folder):
    """Sample states of the patrol measurements, as a finished table: all limits, points and results are made from these."""
    return pinned(subgroups.sample_states(_patrols(spark, folder)))


def _stats(spark, folder):
    return subgroups.subgroup_stats(_patrols(spark, folder))


def _limits_of(rows, **options):
    return lim.control_limits(rows, _time(RUN_TIME), **options)


def _limits(spark, folder, **options):
    return _limits_of(_patrols(spark, folder), **options)


def _charts(spark, folder, slots=None, **options):
    """Points, the limits they belong to, and the slots that long processes are worked on in."""
    states = _states(spark, folder)
    limits = _limits_of(states)
    cuts = cut_points(states, KEY, "begin_mdate", slots)
    return points.chart_points(states, limits, cuts=cuts, **options), limits, cuts


def _points(spark, folder, **options):
    return _charts(spark, folder, **options)[0]


def _judged(spark, folder, slots=None, **options):
    """Results and limits."""
    found, limits, cuts = _charts(spark, folder, slots)
    return rules.judge(found, limits, cuts=cuts, **options), limits


# -- readings and samples ------------------------------------------------------------------------


@query
def parse_readings(spark, folder):
    parsed = subgroups.parse_readings(fixtures.insp(spark, folder))
    return parsed.select("op_code", "id", "value")


@query
def null_normalise(spark, folder):
    events = load(spark, folder, "events")
    raw = (
        F.when(F.col("event_id") % 5 == 0, F.lit("null"))
        .when(F.col("event_id") % 5 == 1, F.lit(""))
        .when(F.col("event_id") % 5 == 2, F.lit(" null "))
        .otherwise(F.concat(F.lit(" "), "props"))
    )
    return events.select("event_id", null_text(raw).alias("props"))


@query
def typed_measurements(spark, folder):
    """Measurements read back from a text table in which NULL is the word null."""
    rows = fixtures.insp(spark, folder)
    raw = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in rows.columns])
    return typed(raw, MEASUREMENTS)


@query
def subgroup_stats(spark, folder):
    kept = _stats(spark, folder)
    return kept.select(
        "op_code", "rcard", "id_no", "n", "mdate",
        *[fixed3(F.col(c)).alias(c) for c in ("total", "span", "deviation")],
    )


@query
def last_n_subgroups(spark, folder):
    taken = subgroups.sample_of_subgroups(_stats(spark, folder), 30, "oldest")
    return taken.select("op_code", "id_no", "num", "n", fixed3(F.col("range")).alias("range"))


@query
def newest_subgroups(spark, folder):
    taken = subgroups.sample_of_subgroups(_stats(spark, folder), 30, "newest")
    return taken.select("op_code", "id_no", "num", "n", fixed3(F.col("range")).alias("range"))


@query
def modal_pcs(spark, folder):
    taken = subgroups.sample_of_subgroups(_stats(spark, folder), 30)
    return taken.groupBy(*KEY).agg(subgroups.modal_size().alias("pcs")).select("op_code", "pcs")


def _ranged(spark, folder, slots=None):
    """Samples with their range. Slots come from the times of the measurements, which need no statistics to be counted."""
    rows = _patrols(spark, folder)
    return subgroups.moving_range(subgroups.subgroup_stats(rows), cuts=cut_points(rows, KEY, "mdate", slots))


@query
def moving_range(spark, folder):
    ranged = _ranged(spark, folder)
    return ranged.select(*SHEET, "n", fixed3(F.col("range")).alias("range"))


@query
def moving_range_slots(spark, folder):
    """The same with every process cut into slots."""
    ranged = _ranged(spark, folder, SLOTS)
    return ranged.select(*SHEET, "n", fixed3(F.col("range")).alias("range"))


@query
def rank_newest_slots(spark, folder):
    rows = fixtures.insp(spark, folder)
    return ranked(rows, KEY, ["mdate", "id"], newest_first=True, slots=SLOTS).select("op_code", "id", "num")


@query
def rank_newest(spark, folder):
    return ranked(fixtures.insp(spark, folder), KEY, ["mdate", "id"], newest_first=True).select("op_code", "id", "num")


@query
def rank_oldest(spark, folder):
    rows = fixtures.insp(spark, folder)
    return ranked(rows, [*KEY, "id_no"], ["mdate", "id"]).select("op_code", "id_no", "id", "num")


@query
def row_id(spark, folder):
    rows = fixtures.insp(spark, folder)
    return rows.select("op_code", "id_no", "id", store.row_id(["op_code", "id_no", "id", "tdata"]).alias("row_id"))


# -- limits --------------------------------------------------------------------------------------


@query
def chart_class(spark, folder):
    kept = _stats(spark, folder)
    return kept.select(*SHEET, "n", lim.chart_class(F.col("n")).alias("chart"))


@query
def chart_constants(spark, folder):
    kept = _stats(spark, folder)
    return lim.with_constants(kept, "n").select(*SHEET, "n", "a2", "d4", "a3", "b4", "b3")


@query
def control_limits(spark, folder):
    return _limits(spark, folder)


@query
def control_limits_newest(spark, folder):
    return _limits(spark, folder, take="newest")


@query
def control_limits_n1(spark, folder):
    return _limits(spark, folder, force_n=1, require_spec=False)


@query
def limits_from_batches(spark, folder):
    """Limits from the sample states of three batches, each read once; cards and sheets go over the borders."""
    rows = _patrols(spark, folder)
    kept = Batches(spark, work_folder(spark), SAMPLE_STATES)
    first, second = _time("2024-01-11 00:00:00"), _time(MARK)
    for _ in range(2):
        kept.commit(subgroups.sample_states(rows.filter(F.col("mdate") <= first)), "1")
        kept.commit(subgroups.sample_states(rows.filter((F.col("mdate") > first) & (F.col("mdate") <= second))), "2")
        kept.commit(subgroups.sample_states(rows.filter(F.col("mdate") > second)), "3")
    return _limits_of(pinned(subgroups.merge_states(kept.read())))


@query
def limits_imr(spark, folder):
    return _limits(spark, folder).filter(F.col("pcs") == 1)


@query
def limits_xbar_r(spark, folder):
    return _limits(spark, folder).filter(F.col("pcs").between(2, 5))


@query
def limits_xbar_s(spark, folder):
    return _limits(spark, folder).filter(F.col("pcs") >= 6)


@query
def limits_scoped(spark, folder):
    rows = scoped(patrols(fixtures.bonding(spark, folder)), op_code="WB", workshop_code="生产三区")
    return lim.control_limits(rows, _time(RUN_TIME))


@query
def limits_export(spark, folder):
    return store.as_text(_limits(spark, folder))


@query
def limits_recode(spark, folder):
    return recoded_limits(fixtures.bonding(spark, folder), _time(RUN_TIME))


@query
def limits_recode_first(spark, folder):
    return recoded_limits(fixtures.bonding(spark, folder), _time(RUN_TIME), recode_first=True)


@query
def limits_relocate(spark, folder):
    return relocated_limits(fixtures.bonding(spark, folder), _time(RUN_TIME))


# -- points and rules ----------------------------------------------------------------------------


@query
def limited_measurements(spark, folder):
    rows = _patrols(spark, folder)
    kept = points.limited_measurements(rows, _limits_of(rows))
    return kept.select("op_code", "id_no", "id", "tdata")


@query
def chart_points(spark, folder):
    return _points(spark, folder)


@query
def points_individual(spark, folder):
    return _points(spark, folder, only_single=True)


@query
def lookback_points(spark, folder):
    rows = _patrols(spark, folder)
    recent = rows.filter(F.col("mdate") > slices.look_back_from(_time(MARK), 10))
    return points.chart_points(recent, _limits_of(rows), mark=_time(MARK))


def _flags(spark, folder, rule, **options):
    found, limits, cuts = _charts(spark, folder)
    flagged = rules.flag_rules(found, limits, [rule], cuts=cuts, **options)
    return flagged.select(
        *SHEET,
        *[F.coalesce(F.col(f"{m}_{rule}"), F.lit(False)).cast("int").alias(m) for m in ("avg", "range", "stddev")],
    )


@query
def rule_outside(spark, folder):
    return _flags(spark, folder, 1)


@query
def rule_2of3(spark, folder):
    return _flags(spark, folder, 2)


@query
def rule_4of5(spark, folder):
    return _flags(spark, folder, 3)


@query
def rule_trend6(spark, folder):
    return _flags(spark, folder, 4)


@query
def rule_trend6_compat(spark, folder):
    return _flags(spark, folder, 4, mode="compat")


@query
def judge_full(spark, folder):
    return _judged(spark, folder)[0]


@query
def judge_full_slots(spark, folder):
    """The same with every process cut into slots."""
    return _judged(spark, folder, SLOTS)[0]


@query
def judge_stream_of_batches(spark, folder):
    """Three batches, judged from the state that the ones before have left; a sheet's rows may take five days to come in."""
    # Written once: ranking all events anew for the limits and for each pass over a batch took most of the time.
    arrived = work_folder(spark)
    found = _patrols(spark, folder)
    store.write_new(found, arrived)
    rows = spark.read.schema(found.schema).parquet(arrived)
    limits = pinned(_limits_of(rows))
    stream = JudgedStream(spark, work_folder(spark))
    high = None
    for number, end in enumerate(("2024-01-11 00:00:00", "2024-01-21 00:00:00", None)):
        slice_ = rows if high is None else rows.filter(F.col("mdate") > high)
        if end:
            high = _time(end)
            slice_ = slice_.filter(F.col("mdate") <= high)
        for _ in range(2):
            stream.run(f"batch-{number}", slice_, limits, high - F.expr("INTERVAL 5 DAYS") if end else None)
    return stream.results.read()


@query
def judge_incremental(spark, folder):
    found, limits, cuts = _charts(spark, folder)
    recent = found.filter(F.col("mdate") > slices.look_back_from(_time(MARK), 90))
    return rules.judge(recent, limits, rules=(1, 4), mark=_time(MARK), need_stddev_limits=True, cuts=cuts)


# -- limit feedback ------------------------------------------------------------------------------


@query
def relimit(spark, folder):
    return recheck.relimit(_judged(spark, folder)[0])


@query
def relimit_n1(spark, folder):
    """Re-check of one data source only: results are laid out by source, so the other one's are not read."""
    found, limits, cuts = _charts(spark, folder)
    by_source = T.StructType([*RESULTS.fields, T.StructField("datasource", T.StringType())])
    kept = Batches(spark, work_folder(spark), by_source, by=["datasource"])
    first = rules.judge(found, limits, cuts=cuts).withColumn("datasource", F.lit("first"))
    second = rules.judge(found, limits, [1], cuts=cuts).withColumn("datasource", F.lit("second"))
    kept.commit(first.unionByName(second), "all")
    results = scoped(kept.read(), datasource="second")
    return recheck.relimit(results, excluded_plants=(), classes=[lim.INDIVIDUAL])


@query
def relimit_apply(spark, folder):
    results, limits = _judged(spark, folder)
    return store.apply_recheck(limits, recheck.relimit(results))


def _some(states):
    return states.filter(F.col("op_code").isin("click", "view", "purchase"))


@query
def limits_upsert(spark, folder):
    """The limits table gets a second version, in which new limits stand in place of older ones. Older copies of a new limit don't count."""
    states = _states(spark, folder)
    table = Versions(spark, work_folder(spark), LIMITS)
    table.write(_limits_of(states), "first")
    fresh = lim.control_limits(_some(states), _time("2024-03-01 00:00:00"), take="newest")
    stale = _limits_of(_some(states), take="newest", force_n=1)
    changes = stale.unionByName(fresh).withColumn("action", F.lit(store.UPSERT))
    table.write(store.merge(table.read(), changes), "second")
    return table.read()


@query
def limits_merge(spark, folder):
    """One pass over the limits that replaces, changes, adds and deletes."""
    states = _states(spark, folder)
    newest = lim.control_limits(states, _time("2024-03-01 00:00:00"), take="newest")
    of = F.col("op_code")
    action = F.when(of == "click", F.lit(store.DELETE)).when(of == "view", F.lit(store.UPDATE)).otherwise(F.lit(store.UPSERT))
    table = Versions(spark, work_folder(spark), LIMITS)
    table.write(_limits_of(states).filter(of != "signup"), "first")
    table.write(store.merge(table.read(), newest.filter(of != "error").withColumn("action", action)), "second")
    return table.read()


@query
def limits_update(spark, folder):
    states = _states(spark, folder)
    changes = _limits_of(states.filter(F.col("op_code") != "click"), take="newest")
    return store.update_limits(_limits_of(states), changes)


@query
def limits_delete(spark, folder):
    limits = _limits(spark, folder)
    return store.delete_keys(limits, limits.filter(F.col("pcs") == 1))


@query
def sink_append(spark, folder):
    path = work_folder(spark) + "/points"
    found = pinned(_points(spark, folder))
    store.append(found.filter(F.col("mdate") <= _time(MARK)), path)
    store.append(found.filter(F.col("mdate") > _time(MARK)), path)
    return spark.read.schema(found.schema).parquet(path)


@query
def points_to_sink(spark, folder):
    """The points job from mark to sink, twice: the mark is the newest time in the sink, so the second run has nothing to add."""
    rows = _patrols(spark, folder)
    limits = pinned(_limits_of(rows))
    sink = Batches(spark, work_folder(spark), POINTS)
    for run in ("first", "second", "second"):
        mark = sink.mark("mdate", _time("2020-06-30 01:12:51.303"))
        recent = rows.filter(F.col("mdate") > slices.look_back_from(mark, 10))
        sink.commit(points.chart_points(recent, limits, mark=mark), run)
    return sink.read()


@query
def sink_partitions(spark, folder):
    """Points written into three files."""
    sink = Batches(spark, work_folder(spark), POINTS)
    sink.commit(_points(spark, folder), "all", partitions=3)
    return sink.read().select("id", F.input_file_name().alias("file")).agg(F.count_distinct("file").alias("n_files"), F.count("id").alias("n_points"))


# -- capability ----------------------------------------------------------------------------------


@query
def cpk_week(spark, folder):
    rows = fixtures.insp(spark, folder)
    bounds = slices.time_range(load(spark, folder, "events"), "ts")
    day = bounds.select(F.to_date("low").alias("low"), F.to_date("high").alias("high"))
    return cpk.capability(rows, "week", day.select("low").scalar(), day.select("high").scalar())


@query
def cpk_onesided(spark, folder):
    found = cpk.capability(fixtures.insp(spark, folder), "week")
    return found.filter(F.col("cpuvalue").isNull() | F.col("cplvalue").isNull())


def _wide(spark, folder, *dropped):
    rows = fixtures.insp_wide(spark, folder)
    return rows.withColumns({name: F.lit("-") for name in dropped})


@query
def cpk_month(spark, folder):
    return cpk.capability(_wide(spark, folder, "op_code", "sta_code"), "month")


@query
def cpk_quarter(spark, folder):
    return cpk.capability(_wide(spark, folder, "part_spec"), "quarter")


@query
def cpk_from_days(spark, folder):
    """Months from a kept table of days that came in two batches, of which the second adds readings to days of the first."""
    rows = _wide(spark, folder)
    kept = Batches(spark, work_folder(spark), DAY_MOMENTS)
    late = F.col("rcard").isin("1", "2")
    kept.commit(cpk.day_moments(rows.filter(~late)), "1")
    kept.commit(cpk.day_moments(rows.filter(late)), "2")
    return cpk.capability(kept.read().withColumns({c: F.lit("-") for c in ("op_code", "sta_code")}), "month")


@query
def cpk_finished_weeks(spark, folder):
    """Weeks appended once they are over; the sink tells up to where that is done."""
    days = pinned(cpk.day_moments(fixtures.insp(spark, folder)))
    sink = Batches(spark, work_folder(spark), capability_schema("week"))
    for run, as_of in enumerate(("2024-01-17", "2024-01-17", "2024-02-05")):
        begun = sink.read().select(F.to_date(F.substring("weektime", 1, 10)).alias("begin"))
        after = slices.high_water_mark(begun, "begin", F.lit("2020-06-29").cast("date")).scalar()
        over = cpk.finished(days, "week", F.lit(as_of).cast("date"), after)
        sink.commit(cpk.capability(over, "week"), f"run-{run}")
    return sink.read()


# -- calendar ------------------------------------------------------------------------------------


def _ranges(spark, folder):
    lines = load(spark, folder, "lineitem")
    return lines.groupBy("l_suppkey").agg(
        F.to_date(F.min("l_shipdate")).alias("begin"), F.to_date(F.max("l_shipdate")).alias("end")
    )


def _periods(spark, folder, unit):
    found = periods.split_periods(_ranges(spark, folder), "begin", "end", unit)
    return found.select("l_suppkey", "period", "year", "label")


@query
def periods_week(spark, folder):
    return _periods(spark, folder, "week")


@query
def periods_month(spark, folder):
    return _periods(spark, folder, "month")


@query
def periods_quarter(spark, folder):
    return _periods(spark, folder, "quarter")


@query
def periods_year(spark, folder):
    return _periods(spark, folder, "year")


@query
def calendar_dim(spark, folder):
    bounds = load(spark, folder, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("low"), F.to_date(F.max("l_shipdate")).alias("high")
    )
    return periods.calendar(periods.days_between(bounds, "low", "high"))


# -- slices --------------------------------------------------------------------------------------


@query
def watermark_slice(spark, folder):
    source = load(spark, folder, "events")
    finished = source.filter(F.col("event_type") == "error").filter(F.col("ts") <= _time(MARK))
    mark = slices.high_water_mark(finished, "ts", _time("2020-06-01 01:12:51"))
    newest = slices.time_range(source, "ts").select("high")
    return slices.between(source, "ts", mark.scalar(), newest.scalar()).select("event_id", "ts", "event_type", "value")


@query
def next_month_slice(spark, folder):
    lines = load(spark, folder, "lineitem")
    finished = lines.filter(F.col("l_shipdate") < _time("1999-06-15 00:00:00")).select(
        F.add_months(F.last_day("l_shipdate"), -1).alias("month_end")
    )
    as_of = F.lit("1999-08-10").cast("date")
    bounds = slices.next_month_bounds(finished, "month_end", F.lit("1995-08-01").cast("date"), as_of)
    kept = slices.day_span(lines, "l_shipdate", bounds)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query
def next_period_slice(spark, folder):
    lines = load(spark, folder, "lineitem")
    done = lines.filter(F.col("l_shipdate") <= _time("2001-03-31 00:00:00"))
    weeks = periods.split_periods(
        done.agg(F.to_date(F.min("l_shipdate")).alias("begin"), F.to_date(F.max("l_shipdate")).alias("end")),
        "begin", "end", "week",
    )
    begin = slices.next_period_begin(weeks, "period_end", F.lit("1995-01-01").cast("date")).scalar()
    kept = lines.filter(F.col("l_shipdate") >= begin)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", day_text(F.to_date("l_shipdate")).alias("ship_day"))


# -- lookups and cleaning ------------------------------------------------------------------------


def _inspections(spark, folder):
    return clean.clean_inspections(*fixtures.inspection_sources(spark, folder))


@query
def inspection_clean(spark, folder):
    return _inspections(spark, folder)


@query
def item_whitelist(spark, folder):
    return lookups.keep_charted(_inspections(spark, folder)).select("id_no", "op_code", "testitem", "tdata")


@query
def item_rejected(spark, folder):
    return lookups.reject_uncharted(_inspections(spark, folder)).select("id_no", "op_code", "testitem", "tdata")


@query
def audit_clean(spark, folder):
    return clean.clean_audits(fixtures.audit_source(spark, folder))


@query
def fqc_clean(spark, folder):
    return clean.clean_final_qc(*fixtures.final_qc_sources(spark, folder))


@query
def wb_join(spark, folder):
    return clean.join_second_source(*fixtures.second_sources(spark, folder))


def _named(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey",
        fixtures.pick(fixtures.WORKSHOP_NAMES, F.col("o_custkey")).alias("workshop_code"),
        F.when(F.col("o_orderkey") % 5 != 4, fixtures.pick(["十级", "千级", "COB", "测试", "其它"], F.col("o_orderkey") % 7))
        .alias("clean_class"),
    )


@query
def workshop_map(spark, folder):
    return lookups.map_workshop(_named(spark, folder)).select("o_orderkey", "workshop_code", "factory")


@query
def workshop_map_class(spark, folder):
    mapped = lookups.map_workshop_by_class(_named(spark, folder), "workshop_code", "clean_class")
    return mapped.select("o_orderkey", "workshop_code", "factory")


@query
def workshop_map_fqc(spark, folder):
    return lookups.map_workshop_final_qc(_named(spark, folder)).select("o_orderkey", "workshop_code", "factory")


@query
def station_recode(spark, folder):
    recoded = lookups.recode_station(fixtures.bonding(spark, folder))
    return recoded.select("id", "workshop_code", "factory", "sta_code", "tdata")


