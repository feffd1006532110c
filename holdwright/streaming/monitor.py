"""New filings: the last accession of every key is kept; a later, different one is reported."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key string, accession string, previous string, at timestamp"


def _watch(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, at = state.get if state.exists else (None, None)
    out = []
    rows = pd.concat(list(frames)).sort_values(["at", "accession"], kind="stable")
    for accession, t in zip(rows["accession"], rows["at"], strict=True):
        if at is not None and t.to_pydatetime() < at:
            continue  # older than what is known: not news
        if last is not None and accession != last:
            out.append((key[0], accession, last, t))
        last, at = accession, t.to_pydatetime()
    if last is not None:
        state.update((last, at))
    yield pd.DataFrame(out, columns=["key", "accession", "previous", "at"])


def changes_stream(filings: DataFrame) -> DataFrame:
    """Streaming filings (key, accession, at) -> OUTPUT. The first accession of a key is only remembered."""
    return filings.groupBy("key").applyInPandasWithState(_watch, OUTPUT, "accession string, at timestamp", "append", GroupStateTimeout.NoTimeout)


def changes_batch(filings: DataFrame) -> DataFrame:
    """The same of a table, by a window over each key."""
    w = Window.partitionBy("key").orderBy("at", "accession")
    d = filings.withColumn("previous", F.lag("accession").over(w))
    return d.filter(F.col("previous").isNotNull() & (F.col("previous") != F.col("accession"))).select("key", "accession", "previous", "at")


def refresh(filings: DataFrame, rebuild, checkpoint: str):
    """Starts a query that hands each batch's changed keys, a small table, to rebuild(keys, batch_id)."""

    def each(batch: DataFrame, batch_id: int) -> None:
        keys = batch.select("key").distinct()
        if keys.limit(1).count():
            rebuild(keys, batch_id)

    return changes_stream(filings).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
