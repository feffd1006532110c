"""What iterative operators share: a folder that all executors see, tables written there, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a session on
    one machine (a local master, as in tests) gets a local folder, which the session keeps; any other fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    It cuts lineage, as checkpoint() does, but compressed and by column; a lost
    executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete what materialize wrote for df, once nothing reads it any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half-round of large-star / small-star on edges (u, v) with u > v."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (node, root) for every node of the undirected edges (u, v): root is
    the smallest node reachable. Nodes may be any ordered type; self-loops and
    repeats are ignored; no edges give no rows.

    Large-star and small-star alternate until nothing changes, which takes about
    log(n) rounds. A node's neighbours are never gathered: the least one comes from
    a combining aggregate, and the join back is one that Spark can split when skewed.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(now, "edges")
    sign = lambda e: e.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = sign(now)
    while before[0]:
        old, now = now, materialize(_star(_star(now, True), False), "edges")
        forget(old)
        after = sign(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
