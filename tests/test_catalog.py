"""Every registered query against its SQL on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from trolley.catalog.oracles import SQL
from trolley.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SMALL):
        view = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "minute" and df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    answer = tables.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in order) for r in answer.fetchall()]
    assert sorted(got, key=str) == sorted(expected, key=str)
