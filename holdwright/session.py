"""Session settings for a run of its own; a cluster's own session works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and skewed joins on. shuffle_partitions: None leaves Spark's."""
    b = SparkSession.builder.master(master).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
