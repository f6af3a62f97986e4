"""Run a query in Spark and its check SQL in DuckDB and compare the two results whole."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def differences(spark_rows, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and all rows agree (order aside)."""
    expected = connection.sql(sql).to_arrow_table()
    actual = spark_rows.toArrow()
    names = sorted(actual.column_names)
    if names != sorted(expected.column_names):
        return [f"columns {names} != {sorted(expected.column_names)}"]
    found = []
    for n in names:
        left, right = actual.schema.field(n).type, expected.schema.field(n).type
        if left != right:
            found.append(f"type of {n}: {left} != {right}")
    left = Counter(zip(*[actual[n].to_pylist() for n in names]))
    right = Counter(zip(*[expected[n].to_pylist() for n in names]))
    if left != right:
        extra, lacking = left - right, right - left
        found.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; columns {names};"
            f" only spark {list(extra)[:3]}; only check {list(lacking)[:3]}"
        )
    return found
