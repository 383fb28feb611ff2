"""Comparing a Spark result with a DuckDB result, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("lineitem", "orders", "supplier", "customer", "nation")


def oracle(folder: str, glob: str = "") -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet{glob}')"
        )
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(record[i] for i in order) for record in records]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(frame):
    return rows(frame.columns, [tuple(r) for r in frame.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows([c[0] for c in cursor.description], cursor.fetchall())


def same(left, right) -> bool:
    """Equal, floats to the last bit."""
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return type(left) is type(right) and left == right
