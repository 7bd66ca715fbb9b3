"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import os

import duckdb

from workload.tables import COLUMNS


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in COLUMNS:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row):
    return tuple((v is not None, v) for v in row)


def assert_same_rows(spark_df, connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(spark_df.columns) == sorted(columns)
    names = sorted(columns)
    left = [tuple(r[spark_df.columns.index(n)] for n in names) for r in spark_df.collect()]
    right = [tuple(r[columns.index(n)] for n in names) for r in expected]
    assert len(left) == len(right)
    assert sorted(left, key=_key) == sorted(right, key=_key)
    # The driver also compares value types: text must stay text on both sides.
    for n, a, b in zip(names, left[0] if left else (), right[0] if right else ()):
        if a is not None and b is not None:
            assert type(a) is type(b), f"{n}: {type(a)} in Spark, {type(b)} in DuckDB"
