"""Every registered query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
import oracles  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402
from tripflow import catalog  # noqa: E402

# the library's own queries; those for training text have tests of their own
QUERIES, ORACLE = {n: entry.queries()[n] for n in catalog.QUERIES}, oracles.sql()


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other, name):
    df = QUERIES[name](spark, SF)
    result = other.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.trips > 0 and row.p50_secs > 0
