"""Every registered query equals its DuckDB oracle on the same driver
tables (columns, row count, types and values, order-insensitive)."""

import os

import duckdb
import pytest

from conftest import SF0001

import __spark_entry__ as E
from shelfline.oracle_sql import oracle_sql
from shelfline.plans.queries import registry
from tools.oracle_check import TABLES, canon

QUERIES = registry()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF0001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 50
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("qid", sorted(QUERIES))
def test_query_matches_oracle(spark, con, qid):
    df = QUERIES[qid](spark, SF0001)
    cols = df.columns
    got = df.collect()
    cur = con.execute(ORACLE[qid])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    s_idx = sorted(range(len(cols)), key=lambda i: cols[i])
    o_idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    s = sorted(tuple(canon(r[i]) for i in s_idx) for r in got)
    o = sorted(tuple(canon(r[i]) for i in o_idx) for r in want)
    assert len(s) == len(o)
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
    assert "order_sk" in df.columns and "payment_gap" in df.columns
