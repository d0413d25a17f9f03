"""Column lists and table schemas shared by all jobs."""

from pyspark.sql import types as T

# A process: one kind of inspection of one part at one station.
KEY = [
    "first_time",
    "workshop_code",
    "part_spec",
    "op_code",
    "sta_code",
    "eattribute1_1",
    "testitem",
    "factory",
]

# One inspection sheet on one run card: the sample behind a control limit.
SUBGROUP = ["rcard", "id_no"]

LIMIT_COLUMNS = ["avgucl", "avglcl", "rangeucl", "rangelcl", "stddevucl", "stddevlcl"]


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_KEY_FIELDS = [(name, T.StringType()) for name in KEY]
_LIMIT_FIELDS = [(name, T.DoubleType()) for name in LIMIT_COLUMNS]

MEASUREMENTS = _struct(
    ("id", T.StringType()),
    *_KEY_FIELDS,
    ("id_no", T.StringType()),
    ("rcard", T.StringType()),
    ("mdate", T.TimestampNTZType()),
    ("lower", T.DoubleType()),
    ("upper", T.DoubleType()),
    ("tdata", T.StringType()),
)

LIMITS = _struct(
    *_KEY_FIELDS,
    ("time", T.TimestampNTZType()),
    ("pcs", T.IntegerType()),
    ("usl", T.DoubleType()),
    ("lsl", T.DoubleType()),
    *_LIMIT_FIELDS,
)

POINTS = _struct(
    ("id", T.StringType()),
    *_KEY_FIELDS,
    ("id_no", T.StringType()),
    ("rcard", T.StringType()),
    ("mdate", T.TimestampNTZType()),
    ("avgvalue", T.DoubleType()),
    ("rangevalue", T.DoubleType()),
    ("stddevvalue", T.DoubleType()),
)

RESULTS = _struct(
    ("id", T.StringType()),
    ("time", T.TimestampNTZType()),
    *_KEY_FIELDS,
    ("id_no", T.StringType()),
    ("rcard", T.StringType()),
    ("samplenum", T.IntegerType()),
    ("usl", T.DoubleType()),
    ("lsl", T.DoubleType()),
    *_LIMIT_FIELDS,
    ("testvalueavg", T.DoubleType()),
    ("testvaluerange", T.DoubleType()),
    ("testvaluestdev", T.DoubleType()),
    ("spcwarn", T.StringType()),
    ("spcgraphtype", T.StringType()),
)

_ORDER = T.DecimalType(38, 0)

# What is kept of a sample's rows; parts of a sample can be merged.
SAMPLE_STATES = _struct(
    *_KEY_FIELDS,
    ("rcard", T.StringType()),
    ("id_no", T.StringType()),
    ("n", T.IntegerType()),
    *[(name, T.DoubleType()) for name in ("total", "low", "high", "squares", "newest_row_sum")],
    ("newest_order", _ORDER),
    ("begin_mdate", T.TimestampNTZType()),
    ("mdate", T.TimestampNTZType()),
    ("lower", T.DoubleType()),
    ("upper", T.DoubleType()),
    ("spec_order", _ORDER),
)

STREAM_STATE = T.StructType([*SAMPLE_STATES.fields, T.StructField("closed", T.BooleanType())])

DAY_MOMENTS = _struct(
    *_KEY_FIELDS,
    ("day", T.DateType()),
    ("readings", T.LongType()),
    ("mean", T.DoubleType()),
    ("squares", T.DoubleType()),
    ("spec_order", _ORDER),
    ("lsl", T.DoubleType()),
    ("usl", T.DoubleType()),
)


def capability_schema(unit: str) -> T.StructType:
    return _struct(
        ("id", T.StringType()),
        (f"{unit}time", T.StringType()),
        ("year", T.StringType()),
        (unit, T.StringType()),
        *_KEY_FIELDS,
        *[(name, T.DoubleType()) for name in ("cpuvalue", "cplvalue", "cpkvalue", "cpkwarnline")],
    )
