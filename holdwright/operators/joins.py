"""Joins by nearness, ranges, prefixes and outer differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def within_days(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, lo: int, hi: int) -> DataFrame:
    """Pairs with lo <= left_date - right_date <= hi, as an equi-join: the right side is
    put in buckets of days and the left side meets the few that its range touches."""
    size = max(hi - lo, 1)
    bucket = lambda d: F.floor(F.unix_date(d) / size).cast("int")
    left = left.withColumn("__b", F.explode(F.sequence(bucket(F.date_sub(F.col(left_date), hi)), bucket(F.date_sub(F.col(left_date), lo)))))
    right = right.withColumn("__b", bucket(F.col(right_date)))
    gap = F.datediff(left_date, right_date)
    return left.join(right, [*keys, "__b"]).drop("__b").withColumn("gap", gap).filter(F.col("gap").between(lo, hi))


def nearest_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, left_date: str, right_date: str, days: int, *ties: Column) -> DataFrame:
    """For each left row the right row of its key nearest in date, if within days; ties by the columns given."""
    pairs = within_days(left, right, keys, left_date, right_date, -days, days)
    w = Window.partitionBy(left_id).orderBy(F.abs("gap"), *ties)
    return pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def difference(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer join on keys: before, after, delta and status (Added, Removed, Increased, Decreased, Unchanged)."""
    b = before.select(*keys, F.col(value).alias("before"))
    a = after.select(*keys, F.col(value).alias("after"))
    d = b.join(a, list(keys), "full_outer").withColumn("delta", F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0)))
    status = (
        F.when(F.col("before").isNull(), "Added")
        .when(F.col("after").isNull(), "Removed")
        .when(F.col("delta") > 0, "Increased")
        .when(F.col("delta") < 0, "Decreased")
        .otherwise("Unchanged")
    )
    return d.withColumn("status", status)


def prefixes(df: DataFrame, name: str, separator: str = " - ") -> DataFrame:
    """(prefix) for every proper prefix of name that ends before a separator: n rows a name, not n * n pairs."""
    parts = F.split(F.col(name), F.lit(separator.replace("-", "\\-")))
    upto = F.explode(F.sequence(F.lit(1), F.size("__parts") - 1)).alias("__upto")
    d = df.select("*", parts.alias("__parts")).filter(F.size("__parts") > 1).select(*df.columns, "__parts", upto)
    return d.select(*df.columns, F.array_join(F.slice("__parts", 1, F.col("__upto")), separator).alias("prefix"))


def drop_rollups(df: DataFrame, keys: Sequence[str], name: str, separator: str = " - ") -> DataFrame:
    """Rows whose name is not a prefix, up to a separator, of another name of the key."""
    inner = prefixes(df.select(*keys, name).distinct(), name, separator).select(*keys, F.col("prefix").alias(name)).distinct()
    return df.join(inner, [*keys, name], "left_anti")


def drop_shadows(df: DataFrame, keys: Sequence[str], has: Column) -> DataFrame:
    """Rows without a value go where another row of the key has one."""
    full = df.filter(has).select(*keys).distinct()
    bare = df.filter(~F.coalesce(has, F.lit(False)))
    return df.filter(has).unionByName(bare.join(full, list(keys), "left_anti").select(*df.columns))
