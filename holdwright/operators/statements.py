"""Series of statement facts: quarters out of year-to-date facts, guards, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from . import dedup, joins
from .aggregate import ranked

#: How a longer fact became a quarter, by its class.
LABELS = ["H1-Q1", "9M-H1", "FY-9M"]


def duration_class(days: Column) -> Column:
    """0 for a quarter, 1 for a half, 2 for nine months, 3 for all else; a fact without days is 3."""
    out = F.lit(3)
    for k, name in reversed(list(enumerate(("quarter", "half", "nine months")))):
        out = F.when(days.between(*vocab.DURATIONS[name]), k).otherwise(out)
    return out


def discrete_quarters(facts: DataFrame, keys: Sequence[str], end: str, days: str, value: str, filed: str, seq: str) -> DataFrame:
    """One row per key and end: the quarter's fact, or a longer one less the next shorter one that ended
    70 to 110 days before (the nearest), or the longer one as it is. Adds derived: how, or null.

    Of facts of one key, end and class the last filed counts, of these the last by seq. The
    two sides meet on key and buckets of days, so a long series is never compared with itself as a whole.
    """
    typed = facts.withColumn("__p", duration_class(F.col(days)))
    last = dedup.keep_best(typed, [*keys, end, "__p"], -F.unix_date(F.coalesce(filed, F.lit("1900-01-01").cast("date"))), -F.col(seq))
    best = dedup.keep_best(last, [*keys, end], F.col("__p"))
    short = last.select(*keys, F.col(end).alias("__end"), (F.col("__p") + 1).alias("__p"), F.col(value).alias("__short"))
    met = joins.within_days(best.select(*keys, end, "__p"), short, [*keys, "__p"], end, "__end", 70, 110)
    near = met.groupBy(*keys, end).agg(F.min(F.struct("gap", "__short")).alias("__b")).select(*keys, end, F.col("__b.__short").alias("__short"))
    out = best.join(near, [*keys, end], "left")
    found = F.col("__short").isNotNull()
    derived = F.when(found, F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.greatest("__p", F.lit(1))))
    out = out.withColumns({value: F.when(found, F.col(value) - F.col("__short")).otherwise(F.col(value)), days: F.when(found, 90).otherwise(F.col(days)), "derived": derived})
    return out.drop("__p", "__short")


def last_periods(df: DataFrame, keys: Sequence[str], end: str, value: str, k: int) -> DataFrame:
    """A row per key with its values at the last k ends, the latest first: q1..qk."""
    r = ranked(df, keys, F.desc(end))
    return r.filter(F.col("rn") <= k).groupBy(*keys).agg(*[F.max(F.when(F.col("rn") == i, F.col(value))).alias(f"q{i}") for i in range(1, k + 1)])


def per_share_guard(df: DataFrame, keys: Sequence[str], seq: str, unit: str, value: str, limit: float = vocab.PER_SHARE_LIMIT) -> DataFrame:
    """Without the values beyond limit of series in dollars a share; a series' unit is that of its first period."""
    first = df.groupBy(*keys).agg(F.min_by(unit, seq).alias("__unit"))
    out = df.join(first, list(keys))
    return out.filter(~F.coalesce((F.col("__unit") == "USD/shares") & (F.abs(F.col(value)) > limit), F.lit(False))).drop("__unit")
