"""The folder all executors share, and tables kept there between steps."""

import uuid

from pyspark.sql import DataFrame, SparkSession

# Only for local sessions without a checkpoint folder.
LOCAL_FOLDER = "/tmp/shopgauge"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one only when Spark itself is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (folder or LOCAL_FOLDER).rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """Name of a new folder in the shared place."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder: a short plan to read many times, and the same rows each time."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
