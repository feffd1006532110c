"""Spread cells at exact halves, query and SQL alike."""

import datetime

import duckdb

from holdwright import plans


def test_halves_go_up(spark, tmp_path):
    prices = [40600.0, 446600.0, 127800.0, 200.0, 600.0, 40599.99, 40600.01, 45000.0]
    day = datetime.datetime(2024, 1, 31)
    rows = [(5 * i, 1, "O", p, day, "1-URGENT") for i, p in enumerate(prices)]
    o = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    o.write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted((r.o_orderkey, r.cell, r.spread) for r in plans.queries()["clean_spreads"](spark, str(tmp_path)).collect())
    assert [c for _, c, _ in got] == ["1.02%", "11.17%", "3.20%", "0.01%", "0.02%", "1.01%", "1.02%", "1.13%"]
    duck = duckdb.connect()
    duck.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(duck.sql(plans.oracle_sql()["clean_spreads"]).fetchall())
