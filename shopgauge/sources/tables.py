"""Reading named tables, and small fixed tables."""

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.functions.readings import null_text

_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}


def load(spark: SparkSession, folder: str, name: str, view: str | None = None) -> DataFrame:
    """A parquet table of a folder, also known to SQL under `view` when given."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if view:
        table.createOrReplaceTempView(view)
    return table


def fixed_table(spark: SparkSession, columns: dict[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A frame of fixed rows. Through Arrow it becomes a local relation, so the planner knows its size."""
    arrays = [pa.array([row[i] for row in rows], _ARROW[kind]) for i, kind in enumerate(columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """A text table with the columns and types of a schema. Spellings of "no value" and bad numbers become NULL."""
    return raw.select(
        *[null_text(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
