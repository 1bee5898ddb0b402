"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.sql(f"CREATE VIEW {name} AS FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(item):
    if isinstance(item, float):
        if math.isnan(item):
            return "nan"
        return item + 0.0
    if isinstance(item, Decimal):
        return ("decimal", str(item))
    return item


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB types that hold the same values.
SAME_TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "boolean": {"BOOLEAN"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
}


def difference(spark_frame, connection, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    result = connection.sql(sql)
    expected_columns = result.columns
    actual_columns = spark_frame.columns
    if sorted(expected_columns) != sorted(actual_columns):
        return f"columns {sorted(actual_columns)} against {sorted(expected_columns)}"
    kinds = dict(zip(result.columns, map(str, result.types), strict=True))
    for name, kind in spark_frame.dtypes:
        if kinds[name] not in SAME_TYPES.get(kind, {kind}):
            return f"type of {name}: {kind} against {kinds[name]}"
    actual = rows_of(actual_columns, spark_frame.collect())
    expected = rows_of(expected_columns, result.fetchall())
    if actual == expected:
        return None
    only_actual, only_expected = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} against {sum(expected.values())}; "
        f"{sum(only_actual.values())} only in Spark, e.g. {list(only_actual)[:2]}; "
        f"{sum(only_expected.values())} only in SQL, e.g. {list(only_expected)[:2]}; "
        f"columns {sorted(actual_columns)}"
    )
