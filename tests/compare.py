"""Order-free comparison of a Spark result with the same query in DuckDB."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_frame, connection, sql):
    """Empty when both give the same columns and rows; else a short description."""
    result = connection.execute(sql)
    want_columns, want = _bag([d[0] for d in result.description], result.fetchall())
    got_columns, got = _bag(spark_frame.columns, spark_frame.collect())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        missing, extra = want - got, got - want
        return (
            f"{sum(want.values())} rows wanted, {sum(got.values())} found; "
            f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
        )
    return ""
