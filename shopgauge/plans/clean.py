"""Cleaning jobs: raw tables to analysis tables. Each is one chain of joins and columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.functions.ids import with_row_ids
from shopgauge.operators import fixed_values as fixed
from shopgauge.operators import lookups

INSPECTION_COLUMNS = [
    "workshop_code", "mdate", "first_time", "rcard", "part_spec", "pixel", "op_code", "sta_code",
    "testitem", "eattribute1_1", "result", "id_no", "lower", "upper", "tdata",
]

AUDIT_COLUMNS = [
    "description", "mdate", "muser", "day", "shift", "partspec", "wocode", "rcard", "stage", "ownetype",
    "promptdeal", "dutyowner", "confirmowner", "qcowner", "dutysta", "dutyday", "remark", "qctype", "id", "area",
    "eattribute1", "eattribute2", "qty", "machineno", "wirepull5", "ballshear1", "ballshear2", "ballshear3",
    "ballshear4", "ballshear5", "ballsize1", "ballsize2", "ballsize3", "ballsize4", "memo1", "memo2", "memo3", "memo4",
]

FINAL_QC_COLUMNS = [
    "wo_code", "pixel", "rcard", "router_code", "op_code", "ok_qty", "sampling_qty", "ec_name", "qty",
    "result", "muser", "mdate", "workshop_code", "factory",
]

SECOND_COLUMNS = [
    "workshop_code", "mdate", "first_time", "rcard", "part_spec", "op_code", "sta_code", "testitem", "eattribute1_1", "id_no",
    "lower", "upper", "tdata", "factory",
]


#: Rows of both sides that a task joins and tells apart; about 1 KB of memory each.
TASK_ROWS = 1 << 18


def clean_inspections(header: DataFrame, detail: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Inspection sheets with their readings, workshop renamed and plant added.

    Join and row ids share one exchange by sheet. It has as many partitions as the rows need, so that a task's sort buffers and hash
    tables, which hold every row of it, stay the same size however many rows come.
    """
    needed = -(-(header.count() + detail.count()) // task_rows)
    partitions = max(needed, header.sparkSession.sparkContext.defaultParallelism)
    sheets = header.withColumnRenamed("eattribute1", "eattribute1_1").repartition(partitions, "id")
    readings = detail.repartition(partitions, "id_no")
    joined = sheets.join(readings, sheets["id"] == readings["id_no"]).select(*INSPECTION_COLUMNS)
    mapped = lookups.map_workshop(joined)
    return with_row_ids(mapped.select(*INSPECTION_COLUMNS, "factory"))


def clean_audits(findings: DataFrame) -> DataFrame:
    """Audit findings with the area renamed by clean-room class, plant and section added."""
    typed = findings.select(*AUDIT_COLUMNS).withColumn("id", F.col("id").cast("double"))
    mapped = lookups.map_workshop_by_class(typed, "area", "eattribute2")
    section = lookups.section_of(F.coalesce("eattribute2", F.lit("")))
    return mapped.withColumn("section", section).select(*AUDIT_COLUMNS, "factory", "section")


def clean_final_qc(
    resume: DataFrame, sn_error: DataFrame, error: DataFrame, material: DataFrame, parameter: DataFrame
) -> DataFrame:
    """Final-QC lots with their defects, product and verdict, workshop renamed and plant added.

    The parameter join adds no column, but a lot appears once per matching parameter.
    """
    lots = resume.filter(F.col("op_code").isin(fixed.FINAL_QC_OPERATIONS))
    joined = (
        lots.join(sn_error, ["rcard", "op_code", "mdate"], "left")
        .join(error, "ec_code", "left")
        .join(material, F.col("item_code") == F.col("part_code"))
        .join(parameter, F.col("op_code") == F.col("pname"), "left")
    )
    verdict = F.when(F.col("qty").isNull() | (F.col("qty") == 0), F.lit("OK")).otherwise(F.lit("NG"))
    mapped = lookups.map_workshop_final_qc(joined.withColumn("result", verdict))
    return with_row_ids(mapped.select(*FINAL_QC_COLUMNS))


def join_second_source(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Bonding patrol readings of the second source, with plant and new station codes."""
    patrols = header.filter((F.col("teststation") == fixed.BONDING) & (F.col("testtype") == fixed.PATROL))
    joined = patrols.join(detail, "id").select(
        F.col("factoryname").alias("workshop_code"),
        F.col("testtime").alias("mdate"),
        F.col("testtype").alias("first_time"),
        "rcard",
        "part_spec",
        F.col("teststation").alias("op_code"),
        F.col("line").alias("sta_code"),
        "testitem",
        F.col("testcondition").alias("eattribute1_1"),
        F.col("id").cast("double").alias("id_no"),
        "lower",
        "upper",
        F.col("subitemtestvalue").alias("tdata"),
    )
    with_plant = lookups.map_second_source_plant(joined)
    workshops = ["生产一区", "生产四区", "古城COB一区"]
    recoded = lookups.recode_station(with_plant, lookups.station_map(joined.sparkSession, workshops))
    return with_row_ids(recoded.select(*SECOND_COLUMNS))
