"""Operators that depend on the order of rows within a key. Every order is given by columns, never by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in columns})


def trailing_median(df: DataFrame, keys: Sequence[str], order: str, value: str, rows: int = 4, name: str = "trailing_median") -> DataFrame:
    """The median of the non-zero values among the ``rows`` rows before each; rows that are null or zero count as rows."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-rows, -1)
    some = F.sort_array(F.collect_list(F.when(F.col(value) != 0, F.col(value))).over(w))
    df = df.withColumn("__some", some)
    n = F.size("__some")
    lo, hi = F.try_element_at("__some", F.floor((n + 1) / 2).cast("int")), F.try_element_at("__some", F.floor(n / 2).cast("int") + 1)
    return df.withColumn(name, F.when(n > 0, (lo + hi) / 2)).drop("__some")


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nulls take the last value before them."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def change_since_known(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """change, change_pct: against the last value that is not null."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(value, ignorenulls=True).over(w)
    return df.withColumn("change", F.col(value) - before).withColumn("change_pct", F.try_divide(F.col("change") * 100, before))


def compounded(df: DataFrame, keys: Sequence[str], order: str, percent: str, n: int = 4, name: str = "compounded") -> DataFrame:
    """The compounded percentage of each key's last n values that are not null; null if there are fewer."""
    r = df.filter(F.col(percent).isNotNull()).withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).filter(F.col("rn") <= n)
    grown = (F.product(1 + F.col(percent) / 100) - 1) * 100
    return r.groupBy(*keys).agg(F.when(F.count(percent) == n, grown).alias(name))


def latest_known(columns: Sequence[str], date: str) -> list[Column]:
    """Aggregates: each column's last value that is not null."""
    return [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(date))).alias(c) for c in columns]


def take_until(df: DataFrame, keys: Sequence[str], order: str, stop: Column) -> DataFrame:
    """Rows before the first that stops; all rows of a key whose first row stops."""
    w = Window.partitionBy(*keys).orderBy(order)
    hit = F.max(F.coalesce(stop, F.lit(False)).cast("int"))
    run = hit.over(w.rowsBetween(Window.unboundedPreceding, 0))
    kept = F.sum(F.when(F.col("__run") == 0, 1).otherwise(0)).over(Window.partitionBy(*keys))
    return df.withColumn("__run", run).withColumn("__kept", kept).filter((F.col("__run") == 0) | (F.col("__kept") == 0)).drop("__run", "__kept")


def chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str = "chunk") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.floor((F.row_number().over(w) - 1) / n).cast("long"))
