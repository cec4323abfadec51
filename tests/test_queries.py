"""Queries against DuckDB on the smallest tables, and the entry's contract."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from minewright.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if x != x else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.oracle])
def test_query_equals_sql(spark, duck, name):
    got = CATALOG[name].run(spark, SF)
    want = duck.sql(CATALOG[name].oracle)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if not q.oracle])
def test_query_without_sql_runs(spark, name):
    assert CATALOG[name].run(spark, SF).count() > 0


def test_entry_and_registers_agree(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
