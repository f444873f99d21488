"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = set()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in registered.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registered.metric_queries()))
def test_query_matches_its_sql(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    if name in ROWS_ONLY:
        assert rows
        return
    result = duck.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, rows) == sorted_rows(columns, result.fetchall())


def test_every_query_has_sql_or_a_reason():
    assert set(registered.metric_queries()) - set(registered.oracle_sql()) == ROWS_ONLY


def test_entry_runs(spark):
    assert registered.entry(spark).columns == ["part", "entity", "instance", "name", "value"]
