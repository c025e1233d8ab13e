"""The queries that SQL can express, against DuckDB over the same tables."""

import os

import duckdb
import pytest

from formloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())
