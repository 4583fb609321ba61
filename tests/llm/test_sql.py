"""Registered queries of the subpackage against their DuckDB SQL, over whole tables."""

import duckdb
import pytest
from conftest import DATA

from tillroll.llm import queries

FOLDER = f"{DATA}/sf0.01"


@pytest.mark.parametrize("name", list(queries.oracles()))
def test_rows_equal_those_of_sql(spark, name):
    tables = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        tables.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = tables.sql(queries.oracles()[name])
    frame = queries.queries()[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(expected.columns)
    rows = sorted(tuple(row) for row in frame.select(expected.columns).collect())
    assert rows and rows == sorted(expected.fetchall())
