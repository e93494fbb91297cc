"""Every query against DuckDB on the driver's tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from locrank.plans.oracle import ORACLE
from locrank.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLE[name])
    columns = [part[0] for part in expected.description]
    expected_rows = _sorted_rows(columns, expected.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    rows = _sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert rows, "a query without rows checks nothing"
    assert rows == expected_rows


def test_entry_runs(spark):
    assert entry_point.entry(spark).columns == ["location", "recovery_rate"]
    assert entry_point.entry(spark).count() > 0
