"""Every query against its DuckDB statement on the smallest tables."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from lakemart.plans.star_oracle import ORACLES
from lakemart.plans.star_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Each of these repeats the whole contract cascade or all marts; one of the family is run here.
REPEATS = {"issue_counts", "platform_scorecard", "failed_checks", "contract_rejected", "stream_bronze_scan"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else repr(value)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - REPEATS))
def test_query_matches(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    names = sorted(frame.columns)
    got = sorted(tuple(plain(row[c]) for c in names) for row in frame.collect())
    cursor = duck.execute(ORACLES[name])
    header = [d[0] for d in cursor.description]
    assert sorted(header) == names
    places = [header.index(c) for c in names]
    assert got == sorted(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
