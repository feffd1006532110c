"""Ranks, percentiles, scaling and nearest rows among peers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def long_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(ids, metric, value), nulls left out."""
    return df.unpivot(list(ids), list(metrics), "metric", "value").filter(F.col("value").isNotNull())


def competition_rank(df: DataFrame, keys: Sequence[str], value: Column, name: str = "rank") -> DataFrame:
    """1 + the number of better rows; df's value must not be null."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(value)))


def percentile_score(df: DataFrame, keys: Sequence[str], worst_first: Column, name: str = "score") -> DataFrame:
    """round(100 * rows worse / (n - 1)); 50 for a single row."""
    w = Window.partitionBy(*keys)
    p = F.round(F.percent_rank().over(w.orderBy(worst_first)) * 100)
    return df.withColumn(name, F.when(F.count(F.lit(1)).over(w) < 2, 50.0).otherwise(p))


def min_max(df: DataFrame, keys: Sequence[str], value: str, name: str = "scaled") -> DataFrame:
    w = Window.partitionBy(*keys)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    return df.withColumn(name, F.try_divide(F.col(value) - lo, hi - lo))


def nearest(df: DataFrame, id_col: str, focus: str, metrics: Sequence[str], k: int = 6) -> DataFrame:
    """The k rows nearest to the focus row by range-normalised distance over metrics.

    Only the focus row and the ranges, one row, are broadcast.
    """
    spans = [F.max(m).alias(f"hi_{m}") for m in metrics] + [F.min(m).alias(f"lo_{m}") for m in metrics]
    at = [F.max(F.when(F.col(id_col) == focus, F.col(m))).alias(f"at_{m}") for m in metrics]
    one = df.agg(*spans, *at).dropna(subset=[f"at_{m}" for m in metrics])  # no focus row, no neighbours
    apart = [F.coalesce(F.try_divide(F.col(m) - F.col(f"at_{m}"), F.col(f"hi_{m}") - F.col(f"lo_{m}")), F.lit(0.0)) for m in metrics]
    d = sum((x * x for x in apart), F.lit(0.0))
    near = df.filter(F.col(id_col) != focus).dropna(subset=list(metrics)).join(F.broadcast(one))
    return near.withColumn("distance", F.sqrt(d)).select(*df.columns, "distance").orderBy("distance", id_col).limit(k)


def leaderboard(df: DataFrame, id_col: str, value: Column, focus: str, k: int = 5) -> DataFrame:
    """The k best and the focus row, with competition ranks. Ranks of the focus are counted, not sorted for."""
    v = df.withColumn("__v", value).filter(F.col("__v").isNotNull())
    top = v.orderBy(F.desc("__v"), id_col).limit(k)
    some = top.unionByName(v.filter(F.col(id_col) == focus)).dropDuplicates([id_col])
    mine = some.select(F.col(id_col).alias("__id"), F.col("__v").alias("__mine"))  # k + 1 rows at most
    ranks = v.select("__v").join(F.broadcast(mine), F.col("__v") > F.col("__mine")).groupBy("__id").agg((F.count("__v") + 1).alias("rank"))
    ranks = mine.select("__id").join(ranks, "__id", "left").fillna(1, ["rank"])
    return some.join(ranks, F.col(id_col) == F.col("__id")).drop("__v", "__id")
