"""Input tables of the jobs, derived from the general test tables by projections and joins."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.operators.keyed import ranked
from shopgauge.schema import MEASUREMENTS
from shopgauge.sources.tables import load

WORKSHOP_NAMES = [
    "生产一区", "生产二区", "生产三区", "生产四区", "生产五区", "生产六区", "生产七区", "生产九区", "NP区", "修复区",
    "3D区", "古城COB一区", "古城COB二区", "古城后段一区", "古城后段二区", "古城试产一区", "古城试产二区",
    "古二COB二区", "古二试产一区", "古二试产二区", "古二测试三区", "SMT", "未知区", "外协区",
]
BONDING_WORKSHOPS = [
    "生产一区", "生产二区", "生产三区", "生产四区", "生产六区", "生产七区", "古城COB一区", "修复区",
]
SAMPLE_SIZES = {"click": 1, "view": 3, "purchase": 5, "signup": 8}
# One plant that re-checks leave out, one process without a plant.
PLANTS = {"view": "台虹厂", "purchase": None}


def pick(names: list[str], number: Column) -> Column:
    """The name at a running number, starting again after the last."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(number, len(names)) + 1).cast("int"))


def insp(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements from events: a process per event type, with samples of 1, 3, 5, 8 and 10 rows."""
    events = load(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    numbered = ranked(events, ["event_type"], ["ts", "event_id"], "rn")
    size = F.coalesce(*[F.when(F.col("event_type") == t, k) for t, k in SAMPLE_SIZES.items()], F.lit(10))
    value = F.col("value").cast("string")
    event = F.col("event_id")
    plant = F.lit("古城二厂")
    for kind, name in PLANTS.items():
        plant = F.when(F.col("event_type") == kind, F.lit(name).cast("string")).otherwise(plant)
    return numbered.select(
        event.cast("string").alias("id"),
        F.lit("巡检").alias("first_time"),
        F.lit("古二COB二区").alias("workshop_code"),
        F.lit("P1").alias("part_spec"),
        F.col("event_type").alias("op_code"),
        F.lit("S1").alias("sta_code"),
        F.lit("A").alias("eattribute1_1"),
        F.lit("value").alias("testitem"),
        plant.alias("factory"),
        F.floor((F.col("rn") - 1) / size).cast("string").alias("id_no"),
        F.floor((F.col("rn") - 1) / size).cast("string").alias("rcard"),
        F.col("ts").alias("mdate"),
        F.when(F.col("event_type") != "error", F.lit(0.0)).alias("lower"),
        F.when(F.col("event_type") != "signup", F.lit(60.0)).alias("upper"),
        F.when(event % 97 == 0, F.lit("NG"))
        .when(event % 89 == 0, F.concat_ws(";", value, value, F.lit("x")))
        .otherwise(value)
        .alias("tdata"),
    ).select(*MEASUREMENTS.fieldNames())


def _line_id() -> Column:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def insp_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements from line items: many processes over several years."""
    lines = load(spark, folder, "lineitem")
    parts = load(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        _line_id().alias("id"),
        F.lit("巡检").alias("first_time"),
        F.lit("古二COB二区").alias("workshop_code"),
        F.col("p_type").alias("part_spec"),
        F.col("l_returnflag").alias("op_code"),
        F.col("p_brand").alias("sta_code"),
        F.lit("A").alias("eattribute1_1"),
        F.lit("quantity").alias("testitem"),
        F.lit("古城二厂").alias("factory"),
        F.col("l_orderkey").cast("string").alias("id_no"),
        F.col("l_linenumber").cast("string").alias("rcard"),
        F.col("l_shipdate").alias("mdate"),
        F.lit(0.0).alias("lower"),
        F.lit(51.0).alias("upper"),
        F.col("l_quantity").cast("string").alias("tdata"),
    ).select(*MEASUREMENTS.fieldNames())


def _bonding_station() -> Column:
    """Old station codes of all three spellings, and codes that no map knows."""
    number = F.lpad((F.col("l_partkey") % 15 + 1).cast("string"), 2, "0")
    even = F.col("l_linenumber") % 2 == 0
    workshop = F.col("workshop_code")
    return (
        F.when(workshop == "古城COB一区", F.concat(F.lit("WB"), number, (F.col("l_partkey") % 3 + 1).cast("string")))
        .when((workshop == "生产一区") & even & (number == "02"), F.lit("WB-01-0030"))
        .when((workshop == "生产四区") & even & (number == "01"), F.lit("WB-03-0226"))
        .otherwise(F.concat(F.lit("WB"), number))
    )


def bonding(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements of bonding stations under their old codes, from line items."""
    lines = load(spark, folder, "lineitem").withColumn("workshop_code", pick(BONDING_WORKSHOPS, F.col("l_suppkey")))
    has_spec = F.col("l_partkey") % 5 != 0
    return lines.select(
        _line_id().alias("id"),
        F.when(F.col("l_linenumber") == 7, F.lit("首检")).otherwise(F.lit("巡检")).alias("first_time"),
        "workshop_code",
        F.lit("P1").alias("part_spec"),
        F.when(F.col("l_returnflag") == "N", F.lit("DB")).otherwise(F.lit("WB")).alias("op_code"),
        _bonding_station().alias("sta_code"),
        F.lit("A").alias("eattribute1_1"),
        F.lit("Wire pull").alias("testitem"),
        F.when(F.col("workshop_code") == "生产四区", F.lit("汉浦厂"))
        .when(F.col("workshop_code") == "古城COB一区", F.lit("古城厂"))
        .otherwise(F.lit("台虹厂"))
        .alias("factory"),
        F.col("l_orderkey").cast("string").alias("id_no"),
        F.col("l_linenumber").cast("string").alias("rcard"),
        F.col("l_shipdate").alias("mdate"),
        F.when(has_spec, F.lit(0.0)).alias("lower"),
        F.when(has_spec, F.lit(51.0)).alias("upper"),
        F.col("l_quantity").cast("string").alias("tdata"),
    ).select(*MEASUREMENTS.fieldNames())


def inspection_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Inspection header and detail, from orders and line items."""
    header = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        pick(WORKSHOP_NAMES, F.col("o_custkey")).alias("workshop_code"),
        F.col("o_orderdate").alias("mdate"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("首检")).otherwise(F.lit("巡检")).alias("first_time"),
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("rcard"),
        F.lit("P1").alias("part_spec"),
        F.lit("8M").alias("pixel"),
        pick(["DB", "WB", "HM", "AA"], F.col("o_orderkey")).alias("op_code"),
        F.concat(F.lit("S"), (F.col("o_orderkey") % 10).cast("string")).alias("sta_code"),
        F.lit("A").alias("eattribute1"),
        F.col("o_orderstatus").alias("result"),
    )
    detail = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id_no"),
        pick(["偏心X", "Wire pull", "浮高Z", "holder shear", "其它"], F.col("l_linenumber")).alias("testitem"),
        F.lit(0.0).alias("lower"),
        F.lit(51.0).alias("upper"),
        F.col("l_quantity").cast("string").alias("tdata"),
    )
    return header, detail


def final_qc_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Final-QC resume, defects, defect names, materials and parameters, from orders, nation and part."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lots = orders.select(
        F.col("o_orderkey").alias("wo_code"),
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("rcard"),
        F.lit("RT1").alias("router_code"),
        pick(["QC外观检", "QC CCD检验", "其它"], F.col("o_orderkey")).alias("op_code"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("ok_qty"),
        (F.col("o_orderkey") % 50).cast("double").alias("sampling_qty"),
        F.concat(F.lit("U"), (F.col("o_custkey") % 9).cast("string")).alias("muser"),
        F.col("o_orderdate").alias("mdate"),
        pick(WORKSHOP_NAMES, F.col("o_custkey")).alias("workshop_code"),
        (F.col("o_custkey") % 200 + 1).alias("item_code"),
    )
    sn_error = lots.filter(F.col("wo_code") % 4 == 0).select(
        "rcard",
        "op_code",
        "mdate",
        (F.col("wo_code") % 30).alias("ec_code"),
        (F.col("wo_code") % 3).cast("double").alias("qty"),
    )
    error = load(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("ec_code"), F.col("n_name").alias("ec_name")
    )
    material = load(spark, folder, "part").select(F.col("p_partkey").alias("part_code"), F.col("p_brand").alias("pixel"))
    parameter = lots.select(F.col("op_code").alias("pname")).distinct()
    return lots, sn_error, error, material, parameter


def audit_source(spark: SparkSession, folder: str) -> DataFrame:
    """Audit findings from suppliers."""
    number = F.col("s_suppkey")
    base = load(spark, folder, "supplier").select(
        F.concat_ws(",", "s_name", F.col("s_nationkey").cast("string"), F.lit("ok")).alias("description"),
        F.lit("2021-01-05 08:00:00").alias("mdate"),
        F.col("s_name").alias("muser"),
        number.cast("string").alias("id"),
        pick(WORKSHOP_NAMES, number).alias("area"),
        F.when(number % 5 != 4, pick(["十级", "千级", "其它"], number)).alias("eattribute2"),
        F.col("s_acctbal").cast("string").alias("qty"),
    )
    texts = [
        "day", "shift", "partspec", "wocode", "rcard", "stage", "ownetype", "promptdeal", "dutyowner",
        "confirmowner", "qcowner", "dutysta", "dutyday", "remark", "qctype", "eattribute1", "machineno",
        "wirepull5", "ballshear1", "ballshear2", "ballshear3", "ballshear4", "ballshear5", "ballsize1",
        "ballsize2", "ballsize3", "ballsize4", "memo1", "memo2", "memo3", "memo4",
    ]
    return base.withColumns({name: F.lit(name) for name in texts})


def second_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Header and detail of the second source, from supplier, nation and line items."""
    number = F.col("s_suppkey")
    suppliers = load(spark, folder, "supplier")
    nations = load(spark, folder, "nation").select("n_nationkey", "n_name")
    station = F.lpad((number % 20 + 1).cast("string"), 2, "0")
    header = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        number.alias("id"),
        pick(["生产一区", "生产四区", "古城COB一区", "未知区"], number).alias("factoryname"),
        F.date_add(F.lit("2021-01-01").cast("date"), number.cast("int")).cast("timestamp_ntz").alias("testtime"),
        F.when(number % 5 == 0, F.lit("首检")).otherwise(F.lit("巡检")).alias("testtype"),
        F.col("s_name").alias("rcard"),
        F.col("n_name").alias("part_spec"),
        F.when(number % 7 == 0, F.lit("DB")).otherwise(F.lit("WB")).alias("teststation"),
        F.when(number % 4 == 2, F.concat(F.lit("WB"), station, F.lit("1")))
        .otherwise(F.concat(F.lit("WB"), station))
        .alias("line"),
    )
    detail = load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        F.lit("Wire pull").alias("testitem"),
        F.col("l_returnflag").alias("testcondition"),
        F.lit(0.0).alias("lower"),
        F.lit(51.0).alias("upper"),
        F.concat_ws(";", F.col("l_quantity").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "subitemtestvalue"
        ),
    )
    return header, detail
