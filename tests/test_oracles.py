"""Every query with SQL against DuckDB on the same tables, and the others' row counts."""

import datetime
import decimal
import math

import duckdb
import pytest

from holdwright import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, sf, duck, name):
    df = plans.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    r = duck.sql(sql)
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)
