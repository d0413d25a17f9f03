"""Small hand-made inputs."""

from datetime import datetime, timedelta

from shopgauge.schema import KEY, LIMIT_COLUMNS, LIMITS, MEASUREMENTS, POINTS, RESULTS

START = datetime(2024, 1, 1)
PLAIN_KEY = {
    "first_time": "巡检",
    "workshop_code": "W",
    "part_spec": "P",
    "op_code": "O",
    "sta_code": "S",
    "eattribute1_1": "A",
    "testitem": "T",
    "factory": "F",
}


def at(minutes):
    return START + timedelta(minutes=minutes)


def _frame(spark, schema, rows, defaults):
    names = schema.fieldNames()
    filled = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in filled], schema)


def measurements(spark, rows):
    """Rows as dicts; id, id_no, rcard and mdate follow the row number unless given."""
    numbered = [
        {"id": str(i), "id_no": str(i), "rcard": "R", "mdate": at(i), **row} for i, row in enumerate(rows)
    ]
    return _frame(spark, MEASUREMENTS, numbered, {**PLAIN_KEY, "lower": 0.0, "upper": 20.0})


def limits(spark, rows):
    defaults = {**PLAIN_KEY, "time": START, "pcs": 1, "usl": 20.0, "lsl": 0.0, "avgucl": 13.0, "avglcl": 7.0,
                "rangeucl": 3.0, "rangelcl": 0.0}
    return _frame(spark, LIMITS, rows, defaults)


def points(spark, rows):
    numbered = [{"id_no": f"{i:04d}", "rcard": "R", "mdate": at(i), **row} for i, row in enumerate(rows)]
    return _frame(spark, POINTS, numbered, PLAIN_KEY)


def results(spark, rows):
    numbered = [{"id_no": f"{i:04d}", "rcard": "R", "time": at(i), **row} for i, row in enumerate(rows)]
    defaults = {**PLAIN_KEY, "samplenum": 1, "usl": 20.0, "lsl": 0.0, "spcwarn": "", "spcgraphtype": "x",
                **dict.fromkeys(LIMIT_COLUMNS)}
    return _frame(spark, RESULTS, numbered, defaults)


def key_of(row):
    return tuple(row[k] for k in KEY)
