"""Checks against reported totals, and repair of units and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse


def band(delta_pct: Column, match: float = 5, near: float = 10) -> Column:
    return F.when(delta_pct.isNull(), "missing").when(F.abs(delta_pct) <= match, "match").when(F.abs(delta_pct) <= near, "near").otherwise("mismatch")


def trust(match: Column, near: Column, mismatch: Column) -> Column:
    """good without a mismatch and with 80 per cent matched; warn from 50 per cent on; else bad; unknown where nothing was checked."""
    checked = match + near + mismatch
    share = parse.safe_ratio(match * 100.0, checked)
    return F.when(checked == 0, "unknown").when((mismatch == 0) & (share >= 80), "good").when(share >= 50, "warn").otherwise("bad")


def balanced(assets: Column, others: Column, share: float = 0.03) -> Column:
    """|A - (L + E)| within 1 or a share of A."""
    return F.abs(assets - others) <= F.greatest(F.lit(1.0), share * F.abs(assets))


def infer_scale(df: DataFrame, keys: Sequence[str], held: str, reported: str, scales: Sequence[float] = (1, 1e3, 1e6, 1e-3, 1e-6)) -> DataFrame:
    """The scale of ``reported`` that brings the median of held / (reported / scale) nearest to 1, in ratio; ties by the order of scales."""
    s = F.posexplode(F.array(*[F.lit(float(x)) for x in scales])).alias("ord", "scale")
    ok = df.filter((F.col(held) > 0) & (F.col(reported) > 0)).select(*keys, held, reported, s)
    med = ok.groupBy(*keys, "ord", "scale").agg(F.median(F.col(held) / (F.col(reported) / F.col("scale"))).alias("ratio"))
    best = F.min(F.struct(F.abs(F.ln("ratio")).alias("error"), "ord", "scale", "ratio")).alias("b")
    return med.groupBy(*keys).agg(best).select(*keys, "b.scale", "b.ratio")


def upper_median(df: DataFrame, keys: Sequence[str], value: str, least: int = 1) -> DataFrame:
    """(keys, __median): of each key's values the middle one, the upper of two, for keys with at least ``least``.

    Values are counted in buckets by the top bits of their order first; the bucket with the middle is known from
    these few counts, and only its values are counted one by one. So a hot key is spread by its values, and a window
    sees buckets or the values of one bucket, never a key's rows.
    """
    bits = F.when(F.col(value) >= 0, F.floor(F.log2(F.greatest(F.col(value), F.lit(1e-300))) * 512)).otherwise(-F.floor(F.log2(-F.col(value)) * 512) - 4_000_000)
    b = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"), bits.cast("long").alias("__b"))
    counts = b.groupBy(*keys, "__b", "__v").agg(F.count(F.lit(1)).alias("__c"))
    per = counts.groupBy(*keys, "__b").agg(F.sum("__c").alias("__k"))
    w = Window.partitionBy(*keys)
    per = per.withColumn("__upto", F.sum("__k").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0))).withColumn("__n", F.sum("__k").over(w))
    mid = F.floor(F.col("__n") / 2)
    at = per.filter((F.col("__n") >= least) & (F.col("__upto") > mid) & (F.col("__upto") - F.col("__k") <= mid))
    at = at.select(*keys, "__b", (mid - F.col("__upto") + F.col("__k")).alias("__skip"))
    one = counts.join(at, [*keys, "__b"])
    run = F.sum("__c").over(Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    return one.withColumn("__run", run).filter(F.col("__run") > F.col("__skip")).groupBy(*keys).agg(F.min("__v").alias("__median"))


def clear_outliers(df: DataFrame, keys: Sequence[str], value: str, factor: float = 500, least: int = 5) -> DataFrame:
    """value is null where it is over factor times the key's upper median, for keys with at least ``least`` values."""
    out = df.join(upper_median(df, keys, value, least), list(keys), "left")
    return out.withColumn(value, F.when(F.col(value) > factor * F.col("__median"), None).otherwise(F.col(value))).drop("__median")


def unit_factor(median: Column, limit: float = 1e6, most: int = 4) -> Column:
    """0.001 for each time the median exceeds limit, at most ``most`` times."""
    k = F.least(F.lit(float(most)), F.ceil(F.log10(median / limit) / 3))
    return F.when(median > limit, F.pow(F.lit(0.001), k)).otherwise(1.0)


def percent_divisor(total: Column) -> Column:
    """What to divide shares by that add up to total: 1000 above 500 per cent, 100 above 150, else 1."""
    return F.when(total > 500, 1000.0).when(total > 150, 100.0).otherwise(1.0)


def decimals_divisor(facts: DataFrame, keys: Sequence[str], concept: str, value: str, decimals: str, limit: float = 100_000) -> DataFrame:
    """(keys, divisor): 1000 where money is told in dollars, else 1.

    A key without amounts has 1. Any decimals of -3 or of 0 and more say dollars; else an upper median of the
    amounts (absolute, not zero) above limit does.
    """
    money = F.lower(F.col(concept)).rlike("fairvalue|cost|amortizedcost|principalamount|balanceprincipal")
    amount = F.abs(F.col(value).try_cast("double"))
    amount = F.when(money & (amount > 0), amount)
    told = F.col(decimals).try_cast("int")
    f = facts.select(*keys, amount.alias("__v"), F.coalesce((told == -3) | (told >= 0), F.lit(False)).alias("__told"))
    said = f.groupBy(*keys).agg(F.bool_or("__told").alias("__told"), F.count("__v").alias("__n"))
    mid = upper_median(f, keys, "__v")
    out = said.join(mid, list(keys), "left")
    dollars = (F.col("__n") > 0) & (F.col("__told") | F.coalesce(F.col("__median") > limit, F.lit(False)))
    return out.select(*keys, F.when(dollars, 1000.0).otherwise(1.0).alias("divisor"))


def filing_divisor(median: Column, scale: Column, limit: float = 100_000) -> Column:
    """1000 for a filing read at the default scale whose median amount is above limit, else 1."""
    return F.when((scale == 1) & (median > limit), 1000.0).otherwise(1.0)


def scaled(df: DataFrame, columns: Sequence[str], factor: Column) -> DataFrame:
    """The money columns times a factor."""
    return df.withColumns({c: F.col(c) * factor for c in columns})


def ratio_repair(principal: Column, other: Column, lo: float = 800, hi: float = 1200) -> Column:
    """principal / 1000 where it is 800 to 1200 times the larger of cost and value, else principal."""
    return F.when((principal > 0) & (other > 0) & (principal / other).between(lo, hi), principal / 1000).otherwise(principal)


def row_divisor(columns: Sequence[Column], limit: float = 2_000_000) -> Column:
    """1000 for a row whose largest amount is at least limit, else 1."""
    return F.when(F.greatest(*[F.coalesce(c, F.lit(0.0)) for c in columns]) >= limit, 1000.0).otherwise(1.0)
