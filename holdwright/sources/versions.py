"""Tables that can be rewritten from themselves, and exports in order: complete, or not there.

Rows go to a folder of their own first. One more line in a small log makes them the current ones, so a write that
fails leaves what was there before, and a reader never sees half of one. Only Spark's readers and writers are
used, so any store that Spark reaches will do.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "version long, folder string, n_rows long, columns array<string>"


def _log(spark: SparkSession, path: str) -> DataFrame:
    """The log of a path, empty where nothing was written yet."""
    try:
        return spark.read.schema(LOG).json(f"{path}/log")
    except AnalysisException:
        return spark.createDataFrame([], LOG)


def _current(spark: SparkSession, path: str):
    return _log(spark, path).orderBy(F.col("version").desc(), F.col("folder").desc()).first()


def _commit(spark: SparkSession, path: str, folder: str, n: int, columns: list[str]) -> int:
    last = _current(spark, path)
    version = 1 + (last["version"] if last else 0)
    spark.createDataFrame([(version, folder, n, columns)], LOG).coalesce(1).write.mode("append").json(f"{path}/log")
    return version


def rewrite(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write df as the next version of the table at path, which df itself may read; its number.

    Earlier versions stay for readers that have begun with them. One writer at a time.
    """
    folder = f"data/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{folder}")
    n = df.sparkSession.read.parquet(f"{path}/{folder}").count() if df.columns else 0
    return _commit(df.sparkSession, path, folder, n, df.columns)


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the last version, or of an earlier one."""
    found = _current(spark, path) if version is None else _log(spark, path).filter(F.col("version") == version).first()
    if found is None:
        raise FileNotFoundError(f"no version of {path}")
    return spark.read.parquet(f"{path}/{found['folder']}").select(*found["columns"])


def _read(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in [*columns, "__part"])
    return spark.read.schema(schema).option("multiLine", "true").csv(folder).withColumn("part", F.col("__part").cast("int")).drop("__part")


def export_csv(df: DataFrame, path: str, *order: Column, parts: int = 8) -> int:
    """Write df as CSV in order: ranges of it, each sorted, as parts whose number (the column ``part``, a folder) ascends. The log has the
    columns once, as the one head, and the number of rows.

    No row passes the driver, and no part is larger than a range. Equal rows of the order lie in one part.
    """
    folder = f"data/{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()).sortWithinPartitions("__part", *order)
    dealt.write.partitionBy("__part").option("header", "false").option("multiLine", "true").csv(f"{path}/{folder}")
    n = _read(df.sparkSession, f"{path}/{folder}", df.columns).count()
    return _commit(df.sparkSession, path, folder, n, df.columns)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The last export's rows as text, with part; FileNotFoundError if there is none."""
    found = _current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no export at {path}")
    return _read(spark, f"{path}/{found['folder']}", found["columns"])
