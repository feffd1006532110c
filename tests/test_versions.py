"""Rewriting from what is read, failed writes, exports in order."""

import tempfile

import pytest
from pyspark.sql import functions as F

from holdwright.sources import versions


def test_rewrite_from_itself(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/t"
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    assert versions.rewrite(spark.range(100).withColumn("k", F.col("id") % 3), path, "k") == 1
    now = versions.read_current(spark, path)
    assert versions.rewrite(now.withColumn("id", F.col("id") + 1000).filter("k < 2"), path) == 2
    assert now.agg(F.sum("id")).first()[0] == 4950  # a reader that has begun keeps its version
    again = versions.read_current(spark, path)
    assert again.columns == ["id", "k"] and again.agg(F.min("id"), F.count("id")).first() == (1000, 67)
    assert versions.read_current(spark, path, 1).count() == 100


def test_failed_rewrite_changes_nothing(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/t"
    versions.rewrite(spark.range(10), path)
    broken = versions.read_current(spark, path).withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit("fine")))
    with pytest.raises(Exception, match="broken"):
        versions.rewrite(broken, path)
    assert sorted(r["id"] for r in versions.read_current(spark, path).collect()) == list(range(10))


def test_export_in_order(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/t"
    rows = [(k * 7919 % 1000, f'a "quoted", text {k}' if k % 3 else None) for k in range(1000)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(5)
    assert versions.export_csv(df, path, F.col("k").desc(), parts=4) == 1
    back = versions.read_csv(spark, path)
    got = back.collect()
    assert sorted((int(r["k"]), r["t"]) for r in got) == sorted(rows, key=lambda r: r[0])
    parts = {}
    for r in got:
        parts.setdefault(r["part"], []).append(int(r["k"]))
    assert len(parts) == 4 and all(v == sorted(v, reverse=True) for v in parts.values())
    bounds = [(max(v), min(v)) for _, v in sorted(parts.items())]
    assert all(a[1] > b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    with pytest.raises(FileNotFoundError):
        versions.read_csv(spark, path + "none")
