"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from auctionflow.plans.catalog import QUERIES
from conftest import SF001, rows

TABLES = ["customer", "orders", "lineitem", "events"]
SQL = entry.oracle_sql()


def _canon(v):
    if v is None:
        return ("~",)
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return ("b", bytes(v).hex())
    if isinstance(v, bool):
        return ("n", float(v))
    if isinstance(v, (int, float)):
        return ("n", float(v))
    return ("s", str(v))


def _norm(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(SQL[name])
    cols = [d[0] for d in rel.description]
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _norm(df.columns, got) == _norm(cols, want)


def test_entry_smoke(spark):
    assert rows(entry.entry(spark)) == rows(QUERIES["flagship"](spark, SF001)) != []
