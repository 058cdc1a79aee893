"""Every registered query against its SQL in DuckDB, over the same Parquet files."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from rowhaul.plans.queries import TABLES


@pytest.fixture(scope="module")
def oracle(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def _sorted(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = sorted(tuple("" if r[i] is None else f"={r[i]}" for i in order) for r in records)
    return [columns[i] for i in order], values


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_its_sql(spark, sf, oracle, name):
    df = entry_points.queries()[name](spark, sf)
    got = _sorted(df.columns, df.collect())
    cursor = oracle.execute(entry_points.oracle_sql()[name])
    want = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
