"""Ids of rows from their values: the same on every run."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _spelled(columns: Sequence[str | Column]) -> list[Column]:
    """Each value with its length before it, so that neither borders nor NULL can be mistaken."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]


def row_id(columns: Sequence[str | Column]) -> Column:
    """Id of a row from its natural key, the same on every run."""
    return F.sha2(F.concat(*_spelled(columns)), 256)


def with_row_ids(df: DataFrame, name: str = "id", chunk: int = 100_000) -> DataFrame:
    """An id for every row, also for rows that are equal in all columns: those are told apart by their occurrence number.

    Equal rows are one row with a count until after the shuffle, so a row that stands there very often is no heavier than others; then
    it is written out `chunk` occurrences at a time. Which of equal rows gets which number makes no difference.
    """
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_times"))
    steps = counted.withColumn("_from", F.explode(F.expr(f"sequence(1L, _times, {chunk}L)")))
    each = steps.withColumn("_occurrence", F.explode(F.expr(f"sequence(_from, least(_from + {chunk - 1}, _times))")))
    spelled = F.concat(*_spelled(df.columns), F.lit("#"), F.col("_occurrence").cast("string"))
    return each.select(F.sha2(spelled, 256).alias(name), *df.columns)
