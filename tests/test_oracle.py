"""Every registered query with SQL gives the same rows in a second engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from wattloom.plans.oracles import oracles
from wattloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=_key)
    assert got == want
