"""Names that are alike: blocked similarity pairs and the clusters they make.

Similarity is 100 * 2 * LCS / (|a| + |b|) of the names with their words sorted, so it
counts insertions and deletions only.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .shared import connected_components


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        m = row & at.get(ch, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([200.0 * lcs(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b, strict=True)])


def sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(F.lower(c)), r"\s+")), " ")


def similar_pairs(names: DataFrame, name: str, block: Column, least: float = 88, lengths: int = 16) -> DataFrame:
    """(a, b, score), a < b, for distinct names of one block with a score of at least ``least``.

    The score bounds the lengths' ratio, so names meet only others of their band of
    lengths or the next ones; the letters in common, each as often as in both, bound it again
    before the exact score. Neither bound loses a pair.
    """
    n = names.select(F.col(name).alias("name"), block.alias("block")).distinct().withColumn("key", sorted_words(F.col("name")))
    ratio = least / (200 - least)  # the shorter is at least this part of the longer
    band = F.floor(F.log(F.greatest(F.length("key"), F.lit(1))) / F.log(F.lit(1 / ratio))).cast("int")
    # The k-th of equal letters is marked with k, so that an intersection counts repeats.
    n = n.withColumn("band", band).withColumn("sorted", F.array_sort(F.split("key", "")))
    n = n.withColumn("bag", F.transform("sorted", lambda x, i: F.concat(x, (i - F.array_position("sorted", x)).cast("string"))))
    left = n.select("block", F.col("name").alias("a"), F.col("key").alias("ka"), F.col("bag").alias("ba"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    right = n.select("block", "band", F.col("name").alias("b"), F.col("key").alias("kb"), F.col("bag").alias("bb"))
    p = left.join(right, ["block", "band"]).filter("a < b")
    together = 200 * F.size(F.array_intersect("ba", "bb")) >= least * (F.length("ka") + F.length("kb")) - 1e-6
    p = p.filter((F.least(F.length("ka"), F.length("kb")) >= ratio * F.greatest(F.length("ka"), F.length("kb")) - 1e-6) & together)
    return p.withColumn("score", similarity("ka", "kb")).filter(F.col("score") >= least).select("a", "b", "score")


def clusters(names: DataFrame, name: str, block: Column, base: Column, least: float = 88) -> DataFrame:
    """(name, canonical): names with one base (without the legal form) are one company, then
    similar ones of a block; the canonical name is the longest, then the least."""
    n = names.select(F.col(name).alias("name"), block.alias("block"), base.alias("base")).distinct()
    same = n.withColumn("least", F.min("name").over(_by("base"))).filter("name <> least").select(F.col("least").alias("a"), F.col("name").alias("b"))
    edges = same.unionByName(similar_pairs(names, name, block, least).select("a", "b"))
    roots = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = n.select("name").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    best = rooted.groupBy("root").agg(F.min(F.struct(-F.length("name"), "name")).alias("b")).select("root", F.col("b.name").alias("canonical"))
    return rooted.join(best, "root").select("name", "canonical")


def _by(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def index(found: DataFrame, key: Column) -> DataFrame:
    """(company_id, canonical, variants) of clusters' rows."""
    return found.groupBy("canonical").agg(F.array_sort(F.collect_set("name")).alias("variants")).select(key.alias("company_id"), "canonical", "variants")


def common_prefixes(names: DataFrame, keys: Sequence[str], name: str, least: int = 10, names_least: int = 2) -> DataFrame:
    """(keys, prefix, n): word-bounded proper prefixes of at least ``least`` letters that several names share."""
    words = F.split(F.col(name), " ")
    d = names.select(*keys, name).distinct().withColumn("__w", words)
    d = d.filter(F.size("__w") > 1).withColumn("__k", F.explode(F.sequence(F.lit(1), F.size("__w") - 1)))
    d = d.select(*keys, F.array_join(F.slice("__w", 1, F.col("__k")), " ").alias("prefix")).filter(F.length("prefix") >= least)
    return d.groupBy(*keys, "prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= names_least)
