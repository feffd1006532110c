"""Aggregations by key: weighted means, breakdowns, coverage, modes, top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize


def weighted_avg(value: Column, weight: Column, positive: bool = True) -> Column:
    """sum(value * weight) / sum(weight) where both are given, over positive values alone by default."""
    ok = value.isNotNull() & weight.isNotNull()
    ok = ok & (value > 0) if positive else ok
    return F.try_divide(F.sum(F.when(ok, value * weight)), F.sum(F.when(ok, weight)))


def with_share(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """name: value's percentage of its sum within keys."""
    return df.withColumn(name, F.try_divide(F.col(value) * 100, F.sum(value).over(Window.partitionBy(*keys))))


def breakdown(df: DataFrame, keys: Sequence[str], by: str, measures: Mapping[str, Column], share_of: str, share: str = "pct") -> DataFrame:
    """measures by (keys, by), with the percentage of one of them within keys.

    The rows are aggregated once; the window over the result has a row for each label.
    """
    return with_share(df.groupBy(*keys, by).agg(*[c.alias(n) for n, c in measures.items()]), keys, share_of, share)


def ranked(df: DataFrame, keys: Sequence[str], *order: Column, name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def ranked_by_spans(df: DataFrame, keys: Sequence[str], span: Column, *order: Column, name: str = "rn", of: str = "n") -> DataFrame:
    """As ``ranked``, with the key's rows in ``of``, for keys of very many rows. span must ascend with the order, nulls first: rows are
    numbered within their span, and those of the spans before are added, so a span is one task's and a key is not."""
    d = df.withColumn("__span", span)
    n = d.groupBy(*keys, "__span").agg(F.count(F.lit(1)).alias("__k"))
    w = Window.partitionBy(*keys)
    n = n.withColumns({of: F.sum("__k").over(w), "__before": F.coalesce(F.sum("__k").over(w.orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    n = materialize(n, "spans").select(*[F.col(k).alias(f"{k}__r") for k in (*keys, "__span")], of, "__before")
    same = F.lit(True)
    for k in (*keys, "__span"):
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__r"))
    return ranked(d, ["__span", *keys], *order, name=name).join(n, same).withColumn(name, F.col(name) + F.col("__before")).select(*df.columns, name, of)


def top_k(df: DataFrame, keys: Sequence[str], k: int, *order: Column, name: str = "rn") -> DataFrame:
    """The first k rows of each key; order must break all ties."""
    return ranked(df, keys, *order, name=name).filter(F.col(name) <= k)


def top_k_and_other(df: DataFrame, keys: Sequence[str], by: str, sums: Sequence[str], k: int, most: int, other: str = "Other") -> DataFrame:
    """Labels beyond the k largest (by the first of sums) as one, where a key has more than ``most``. df has a row per label."""
    n = F.count(by).over(Window.partitionBy(*keys))
    r = ranked(df.withColumn("n_labels", n), keys, F.desc(sums[0]), F.asc(by))
    label = F.when((F.col("n_labels") > most) & (F.col("rn") > k), other).otherwise(F.col(by))
    return r.withColumn(by, label).groupBy(*keys, by).agg(*[F.sum(s).alias(s) for s in sums])


def zero_filled(df: DataFrame, keys: Sequence[str], by: str, labels: Sequence[str], zeros: Sequence[str]) -> DataFrame:
    """A row for every label of each key; what is missing is zero. labels is a short fixed list."""
    every = df.select(*keys).distinct().withColumn(by, F.explode(F.array(*[F.lit(x) for x in labels])))
    out = every.join(df, [*keys, by], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in zeros})


def coverage(df: DataFrame, keys: Sequence[str], weight: Column, fields: Mapping[str, Column]) -> DataFrame:
    """For each condition, the percentage of weight that meets it, in one pass."""
    total = F.sum(weight)
    return df.groupBy(*keys).agg(*[F.coalesce(F.try_divide(F.sum(F.when(ok, weight)) * 100, total), F.lit(0)).alias(n) for n, ok in fields.items()])


def mode_first(df: DataFrame, keys: Sequence[str], value: str, seq: Column, name: str = "mode") -> DataFrame:
    """The most frequent value of each key, the first seen of those tied. (keys, name, count)"""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("count"), F.min(seq).alias("first_seq"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("count")).alias("c"), "first_seq", F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(name), (-F.col("b.c")).alias("count"))


def latest(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows of each key's last date. Only the dates are aggregated; the join back is a semi-join."""
    last = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(last, [*keys, date], "left_semi")
