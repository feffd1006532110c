"""The queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from holdwright.llm import queries


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, sf, name):
    c = duckdb.connect()
    for t in "documents embeddings pages benchmark conversations".split():
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[x]) for x in cols) for r in df.collect()), key=str)
    r = c.sql(queries.oracle_sql()[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(x) for x in cols]
    assert got == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {k: kinds[v] for k, v in df.dtypes} == dict(zip(r.columns, map(str, r.types), strict=True))
