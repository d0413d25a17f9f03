"""Rounding at the hand-overs between jobs."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed3(value: Column) -> Column:
    """Round half up to three decimals.

    The decimal step first drops the noise of summing in a different order, so that the
    same readings give the same result whatever the partitioning was. A number too large for that has
    no decimals and stays as it is.
    """
    return F.coalesce(F.round(value.try_cast("decimal(38,9)"), 3).cast("double"), value)
