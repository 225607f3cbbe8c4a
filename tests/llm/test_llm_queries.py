"""Queries with SQL against the other engine, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402
from tripflow.llm.queries import QUERIES, SQL  # noqa: E402


def test_registered():
    names = set(entry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    other = duckdb.connect()
    for table in TABLES:
        other.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    result = other.execute(SQL[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
