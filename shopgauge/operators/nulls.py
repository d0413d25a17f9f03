"""Joins in which NULL equals NULL."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys in which NULL equals NULL, keeping the key columns of the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.expr(" AND ".join(f"{k} <=> _r_{k}" for k in keys))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])
