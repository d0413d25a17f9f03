"""Name and code lookups. Each map is a small fixed table joined by broadcast, or a frame given by the caller."""

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.operators import fixed_values as fixed
from shopgauge.sources.tables import fixed_table


def charted_pairs(spark: SparkSession) -> DataFrame:
    """(operation, test item) pairs that are charted: 60 rows."""
    pairs = [(op, item) for op, items in fixed.CHARTED_ITEMS.items() for item in items]
    return fixed_table(spark, {"op_code": "string", "testitem": "string"}, pairs)


def keep_charted(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(charted_pairs(df.sparkSession)), ["op_code", "testitem"], "left_semi")


def reject_uncharted(df: DataFrame) -> DataFrame:
    """The rows that keep_charted leaves out."""
    return df.join(F.broadcast(charted_pairs(df.sparkSession)), ["op_code", "testitem"], "left_anti")


def workshop_map(spark: SparkSession) -> DataFrame:
    rows = [(old, plant, new) for old, (plant, new) in fixed.WORKSHOPS.items()]
    return fixed_table(spark, {"_old": "string", "_plant": "string", "_new": "string"}, rows)


def workshop_map_by_section(spark: SparkSession) -> DataFrame:
    """As workshop_map, with one new name per section; outside the split workshops all three are the same."""
    rows = [(old, plant, None, cob, test) for old, (plant, cob, test) in fixed.WORKSHOPS_BY_SECTION.items()]
    plain = {**fixed.WORKSHOPS, **fixed.WORKSHOPS_EXTRA}
    rows += [
        (old, plant, new, new, new)
        for old, (plant, new) in plain.items()
        if old not in fixed.WORKSHOPS_BY_SECTION
    ]
    columns = dict.fromkeys(["_old", "_plant", "_any", "_cob", "_test"], "string")
    return fixed_table(spark, columns, rows)


def _with_plant(df: DataFrame, mapping: DataFrame, workshop: str, new: Column, factory: str) -> DataFrame:
    """Replace the workshop by its new name and add its plant; unknown workshops stay and have no plant."""
    joined = df.join(F.broadcast(mapping), F.col(workshop) == F.col("_old"), "left")
    named = joined.withColumns(
        {
            workshop: F.when(F.col("_old").isNull(), F.col(workshop)).otherwise(new),
            factory: F.col("_plant"),
        }
    )
    return named.drop(*mapping.columns)


def map_workshop(df: DataFrame, workshop: str = "workshop_code", factory: str = "factory") -> DataFrame:
    return _with_plant(df, workshop_map(df.sparkSession), workshop, F.col("_new"), factory)


def map_workshop_by_class(df: DataFrame, workshop: str, clean_class: str, factory: str = "factory") -> DataFrame:
    """New name by workshop and clean-room class; a split workshop with another class has no new name."""
    new = (
        F.when(F.col(clean_class).isin(fixed.CLASS_SPELLINGS["COB"]), F.col("_cob"))
        .when(F.col(clean_class).isin(fixed.CLASS_SPELLINGS["测试"]), F.col("_test"))
        .otherwise(F.col("_any"))
    )
    return _with_plant(df, workshop_map_by_section(df.sparkSession), workshop, new, factory)


def map_workshop_final_qc(df: DataFrame, workshop: str = "workshop_code", factory: str = "factory") -> DataFrame:
    """Final QC happens in the test section, so split workshops take that name."""
    return _with_plant(df, workshop_map_by_section(df.sparkSession), workshop, F.col("_test"), factory)


def section_of(clean_class: Column) -> Column:
    section = F.when(clean_class == "十级", fixed.CLASS_SECTION["十级"])
    return section.when(clean_class == "千级", fixed.CLASS_SECTION["千级"]).otherwise("")


def map_second_source_plant(df: DataFrame, workshop: str = "workshop_code", factory: str = "factory") -> DataFrame:
    rows = list(fixed.SECOND_SOURCE_PLANTS.items())
    mapping = fixed_table(df.sparkSession, {"_old": "string", "_plant": "string"}, rows)
    joined = df.join(F.broadcast(mapping), F.col(workshop) == F.col("_old"), "left")
    return joined.withColumn(factory, F.col("_plant")).drop("_old", "_plant")


STATION_COLUMNS = dict.fromkeys(["_workshop", "_factory", "_old", "_new"], "string")
#: Fixed values, one line per station: workshop, plant (empty for any), old code, new code.
STATIONS_FILE = Path(__file__).with_name("stations.csv")
#: The same for the workshop that moved to another plant.
MOVED_STATIONS = Path(__file__).with_name("moved_stations.csv")


def _station_table(spark: SparkSession, path: Path | str, workshops: list[str] | None = None) -> DataFrame:
    with open(path, encoding="utf-8", newline="") as file:
        rows = [(r["workshop"], r["plant"] or None, r["old"], r["new"]) for r in csv.DictReader(file)]
    return fixed_table(spark, STATION_COLUMNS, [r for r in rows if workshops is None or r[0] in workshops])


def station_map(spark: SparkSession, workshops: list[str] | None = None, path: Path | str = STATIONS_FILE) -> DataFrame:
    """(workshop, plant or NULL for any, old code, new code), of some workshops if they are named."""
    return _station_table(spark, path, workshops)


def move_map(spark: SparkSession, path: Path | str = MOVED_STATIONS) -> DataFrame:
    """Old code -> new code for the workshop that moved; stations outside the moved lines get their own new code."""
    return _station_table(spark, path)


def _match_station(df: DataFrame, mapping: DataFrame) -> DataFrame:
    on = (
        (F.col("sta_code") == F.col("_old"))
        & (F.col("workshop_code") == F.col("_workshop"))
        & (F.col("_factory").isNull() | (F.col("factory") == F.col("_factory")))
    )
    return df.join(F.broadcast(mapping), on, "left")


def recode_station(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Replace old station codes by new ones, per workshop and plant; unknown codes stay."""
    mapping = station_map(df.sparkSession) if mapping is None else mapping
    matched = _match_station(df, mapping)
    return matched.withColumn("sta_code", F.coalesce("_new", "sta_code")).drop(*mapping.columns)


def relocate(df: DataFrame) -> DataFrame:
    """Recode the stations of the workshop that moved, and name its new workshop and plant."""
    mapping = move_map(df.sparkSession)
    matched = _match_station(df, mapping)
    workshop, factory = fixed.MOVED_TO
    moved = F.col("_new").isNotNull()
    return matched.withColumns(
        {
            "sta_code": F.coalesce("_new", "sta_code"),
            "workshop_code": F.when(moved, F.lit(workshop)).otherwise(F.col("workshop_code")),
            "factory": F.when(moved, F.lit(factory)).otherwise(F.col("factory")),
        }
    ).drop(*mapping.columns)
