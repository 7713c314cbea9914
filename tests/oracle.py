"""Compares a Spark result with DuckDB's answer to the oracle SQL."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, row count, Python types and values agree."""
    answer = connection.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = _sorted_rows(columns, answer.fetchall())
    actual = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if sorted(columns) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} against {sorted(columns)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows against {len(expected)}"]
    return [f"{a} against {e}" for a, e in zip(actual, expected) if a != e]
