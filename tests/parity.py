"""Comparison of a Spark result with the result of the matching SQL."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if glob.glob(f"{sf_dir}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(frame, connection, sql: str) -> str | None:
    """None where both results hold the same rows and column names, else what differs first."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, frame.collect())
    if len(expected) != len(actual):
        return f"{len(actual)} rows != {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            return f"{left} != {right}"
    return None


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
