from __future__ import annotations

import os

import duckdb
import pytest
from profitgrid.llm import queries

TABLES = ("documents", "embeddings", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, small, name):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{small}/{table}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    want = connection.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, small)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want.fetchall(), key=str)
