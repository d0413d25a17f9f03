"""Limit jobs for given workshops: scope, limits, new codes."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.operators import fixed_values as fixed
from shopgauge.operators import lookups
from shopgauge.operators.keyed import latest_per_key
from shopgauge.operators.limits import control_limits
from shopgauge.schema import KEY, LIMIT_COLUMNS, LIMITS

# What tells two limits of one key apart when their times are the same.
_LATEST = ["mdate", "pcs", *LIMIT_COLUMNS]


def patrols(measurements: DataFrame) -> DataFrame:
    return measurements.filter(F.col("first_time") == fixed.PATROL)


def scoped(measurements: DataFrame, **equal: str) -> DataFrame:
    """Rows whose columns equal the given values."""
    for column, value in equal.items():
        measurements = measurements.filter(F.col(column) == value)
    return measurements


def _coded_limits(
    measurements: DataFrame, recode: Callable[[DataFrame], DataFrame], run_time: Column | None, recode_first: bool, **options
) -> DataFrame:
    if recode_first:
        return control_limits(recode(measurements), run_time, require_spec=False, **options)
    limits = control_limits(measurements, run_time, require_spec=False, keep_mdate=True, **options)
    return latest_per_key(recode(limits), KEY, _LATEST).select(*LIMITS.fieldNames())


def recoded_limits(
    measurements: DataFrame, run_time: Column | None = None, recode_first: bool = False, **options
) -> DataFrame:
    """Bonding limits of all workshops under their new station codes.

    Limits are computed under the old codes; when two of them become one code the limit with the newer
    measurements stays. With recode_first the measurements are merged instead.
    """
    rows = scoped(patrols(measurements), op_code=fixed.BONDING)
    return _coded_limits(rows, lookups.recode_station, run_time, recode_first, **options)


def relocated_limits(
    measurements: DataFrame, run_time: Column | None = None, recode_first: bool = False, **options
) -> DataFrame:
    """As recoded_limits, for the workshop that moved to another plant."""
    workshop, factory = fixed.MOVED_FROM
    rows = scoped(patrols(measurements), op_code=fixed.BONDING, workshop_code=workshop, factory=factory)
    return _coded_limits(rows, lookups.relocate, run_time, recode_first, **options)
