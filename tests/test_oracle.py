"""Every registered key against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.plans.registry import oracle_queries, query_registry
from shelfwise.sources.tables import TABLE_NAMES

from conftest import SF01

KEYS = sorted(query_registry())
SQL = oracle_queries()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_key_has_oracle():
    missing = [k for k in KEYS if k not in SQL]
    assert missing == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_formatted_date", "order_status", "total_amount", "total_orders"]


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = query_registry()[key](spark, SF01)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[key])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
