"""Removal of repeated rows: exact, by key, and greedy within a tolerance."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator, Sequence
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import parse_date


def populated(columns: Sequence[str]) -> Column:
    """How many of the columns are neither null nor blank."""
    return sum((F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", 1).otherwise(0) for c in columns), F.lit(0))


def keep_best(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row of each key, the first in order; order must break all ties. A struct minimum, so it combines before the shuffle."""
    best = F.min(F.struct(*[o.alias(f"__{k}") for k, o in enumerate(order)], F.struct(*[c for c in df.columns if c not in keys]).alias("row")))
    return df.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.row.*").select(*df.columns)


def keep_richest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *ties: Column) -> DataFrame:
    """One row of each key, with the most columns populated."""
    return keep_best(df, keys, -populated(columns), *ties)


def first_then_latest(df: DataFrame, first_keys: Sequence[str], seq: Column, latest_keys: Sequence[str], date: Column) -> DataFrame:
    """The first row seen of each first key, then the last dated of each latest key."""
    once = keep_best(df, first_keys, seq)
    return keep_best(once, latest_keys, -F.unix_date(date), seq)


def drop_close(df: DataFrame, keys: Sequence[str], value: str, seq: str, ratio: float, lane: str | None = None) -> DataFrame:
    """Greedy: in order of seq, a row goes if smaller / larger of its value and a kept row's
    (of its key and lane) is at least ratio. Nearness isn't transitive, so the order decides.

    A key's rows come sorted and stream by; only the current key's kept values are held, which
    are pairwise further apart than ratio allows, so they grow with the logarithm of the values' range.
    """
    by = [*keys, *([lane] if lane else [])]
    names = df.columns
    places, at, first = [names.index(c) for c in by], names.index(value), [F.col(c) for c in by]
    dealt = df.repartition(*first).sortWithinPartitions(*first, F.col(seq).asc_nulls_last(), value)

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept = None, []
        for b in batches:
            stay = np.ones(b.num_rows, bool)
            here = zip(*[b.column(p).to_pylist() for p in places], strict=True) if places else [()] * b.num_rows
            for i, (k, v) in enumerate(zip(here, b.column(at).to_pylist(), strict=True)):
                if k != key:
                    key, kept = k, []
                if v is None or not 0 < v < inf:  # two infinite values have no ratio
                    continue
                v = float(v)
                j = bisect(kept, v)
                if (j and kept[j - 1] / v >= ratio) or (j < len(kept) and v / kept[j] >= ratio):
                    stay[i] = False
                else:
                    kept.insert(j, v)
            yield b.filter(pa.array(stay))

    return dealt.mapInArrow(greedy, df.schema)


def keep_better(df: DataFrame, keys: Sequence[str], value: str, rank: Sequence[Column], tolerance: float = 0.01) -> DataFrame:
    """Of rows of one key whose values differ by at most tolerance of the larger size (1 at least), or are both null, the better
    ones by rank (a struct, the smallest is best); equal ranks stay side by side.

    Nearness isn't transitive: the best row decides first, and a row goes if it is near one that stays and is better. A key's
    rows come sorted and stream by; the values of its rows that stay are held, not the rows.
    """
    names = df.columns
    d = df.withColumn("__rank", F.struct(*rank)).withColumn("__value", F.col(value).cast("double"))
    first = [F.col(k) for k in keys]
    d = d.repartition(*first).sortWithinPartitions(*first, "__rank")
    d = d.withColumn("__tie", F.xxhash64(F.to_json("__rank", {"ignoreNullFields": "false"}))).select(*names, "__value", "__tie")
    places = [names.index(k) for k in keys]

    def near(kept: list[float], v: float) -> bool:
        j = bisect(kept, v)
        return any(abs(v - kept[i]) <= tolerance * max(abs(v), abs(kept[i]), 1.0) for i in (j - 1, j) if 0 <= i < len(kept))

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tie, kept, level, none, none_now = None, None, [], [], False, False
        for b in batches:
            stay = np.ones(b.num_rows, bool)
            here = zip(*[b.column(p).to_pylist() for p in places], strict=True)
            for i, (k, v, t) in enumerate(zip(here, b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist(), strict=True)):
                if k != key:
                    key, tie, kept, level, none, none_now = k, t, [], [], False, False
                if t != tie:  # what stayed of the rank before now counts
                    for x in level:
                        j = bisect(kept, x)
                        if not (j and kept[j - 1] == x):
                            kept.insert(j, x)
                    tie, level, none = t, [], none or none_now
                if v is None:
                    stay[i], none_now = not none, True
                elif near(kept, v):
                    stay[i] = False
                else:
                    level.append(v)
            yield b.filter(pa.array(stay)).select(names)

    return d.mapInArrow(greedy, df.schema)


# Cells that hold no money.
NO_MONEY = ["", "N/A", "n/a", "-", "0", "0.0"]


def drop_worse_positions(rows: DataFrame, company: str, kind: str, principal: str, maturity: str, money: Sequence[str], fields: Sequence[str], size: str) -> DataFrame:
    """Positions of one company (its name before a bracket, case and blanks aside) and kind whose principals are within 1 per cent: those with
    the later maturity stay, then those with any, then those with more fields, then those of the larger table. Rows without money go.

    principal is a cell; one that is no number counts as blank, and blank ones are near each other.
    """
    some = F.lit(False)
    for c in money:
        some = some | ~F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).isin(*NO_MONEY)
    squeeze = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    d = rows.filter(some).withColumns({
        "__company": squeeze(F.substring_index(F.col(company), "(", 1)), "__kind": squeeze(F.col(kind)),
        "__principal": F.regexp_replace(F.col(principal).cast("string"), "[, ]", "").try_cast("double"),
        "__day": parse_date(F.col(maturity).cast("string")),
    })
    undated = F.col("__day").isNull()
    rank = [-F.coalesce(F.unix_date("__day"), F.lit(-1_000_000)), F.when(undated, -populated(fields)), F.when(undated, -F.col(size))]
    kept = keep_better(d, ["__company", "__kind"], "__principal", [r.alias(f"r{k}") for k, r in enumerate(rank)])
    return kept.drop("__company", "__kind", "__principal", "__day")
