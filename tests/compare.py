"""Compare a query's rows with those of its SQL, value by value and without regard to order."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical_rows(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def difference(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else what differs."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = canonical_rows(expected_columns, result.fetchall())
    if sorted(spark_frame.columns) != sorted(expected_columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(expected_columns)}"
    actual = canonical_rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows differ, first: {wrong[0][0][:600]} <> {wrong[0][1][:600]}" if wrong else None
