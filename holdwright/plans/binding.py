"""The portfolio tables over the driver's star schema, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table dealt to all cores by its key, for rows that take long: a narrow table is few files, and so few tasks, at any size."""
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, sf_dir, name).repartition(n, key)


def money(c):
    """Exact to four places, so that sums don't depend on their order."""
    return F.round(c, 4).cast("decimal(18,4)")


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions: a line is a position of a borrower (customer) in a fund (the supplier's nation) at a quarter's end.

    The dimensions are joined without hints: Spark broadcasts those whose size allows it. A line's own columns are worked out
    first, so a query's shuffles carry those that it names; orders, the widest side, have their customer and come last.
    """
    t = lambda n: table(spark, sf_dir, n)
    price = F.col("l_extendedprice")
    lines = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.date_sub(F.add_months(F.trunc("l_shipdate", "quarter"), 3), 1).alias("period"),
        money(price * (1 - F.col("l_discount"))).alias("fv"), money(price * (1 - F.col("l_tax"))).alias("cost"), money(price).alias("principal"),
        (F.col("l_tax") * 100).alias("cash_rate"), (F.col("l_discount") * 100).alias("spread"), (F.year("l_shipdate") + F.col("l_linenumber")).alias("matures"),
    )
    funds = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("ticker"))
    parts = t("part").select("p_partkey", F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"))
    rate = F.when(F.col("o_orderpriority") == "1-URGENT", "SOFR").when(F.col("o_orderpriority") == "2-HIGH", "LIBOR")
    rate = rate.when(F.col("o_orderpriority") == "3-MEDIUM", "Prime").when(F.col("o_orderpriority") == "5-LOW", "Fixed")
    orders = t("orders").select("o_orderkey", "o_custkey", rate.alias("rate"), F.col("o_orderdate").cast("date").alias("acquired"))
    borrowers = t("customer").select("c_custkey", F.col("c_name").alias("company"), F.col("c_mktsegment").alias("industry"))
    orders = orders.join(borrowers, F.col("o_custkey") == F.col("c_custkey"))
    j = lines.join(funds, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("ticker", "period", "company", "kind", "industry", "brand", "fv", "cost", "principal", "cash_rate", "spread", "rate", "acquired", "matures")


HOLDINGS = """
WITH h AS (
  SELECT n_name AS ticker, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period,
    c_name AS company, p_type AS kind, c_mktsegment AS industry, p_brand AS brand,
    CAST(round(l_extendedprice * (1 - l_discount), 4) AS DECIMAL(18,4)) AS fv,
    CAST(round(l_extendedprice * (1 - l_tax), 4) AS DECIMAL(18,4)) AS cost,
    CAST(round(l_extendedprice, 4) AS DECIMAL(18,4)) AS principal,
    l_tax * 100 AS cash_rate, l_discount * 100 AS spread,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'SOFR' WHEN '2-HIGH' THEN 'LIBOR' WHEN '3-MEDIUM' THEN 'Prime' WHEN '5-LOW' THEN 'Fixed' END AS rate,
    CAST(o_orderdate AS DATE) AS acquired, year(l_shipdate) + l_linenumber AS matures
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""
