"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from trolley.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{table}'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    answer = connection.execute(SQL[name])
    order = [[d[0] for d in answer.description].index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in answer.fetchall()]
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(expected, key=str)
