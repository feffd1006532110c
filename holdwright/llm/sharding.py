"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own; the
shards take turns, each claiming its next free slot, until the table is full. A
key's shard is the table at its hash, so placement is one lookup, shards get equal
numbers of slots (within one), and few keys move when a shard comes or goes.

Defined results: a null key is placed as the empty string; repeated keys share a
shard; an empty input gives no rows; no shards are an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prime; over a hundred slots a shard keeps the shares within one per cent.
SLOTS = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards=SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard's index for every slot. slots is prime and bounds the work and the size."""
    if not shards:
        raise ValueError("no shards")
    if slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, at least the number of shards")
    first = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    turn, table, left = [0] * len(shards), [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            while table[at := (first[k] + turn[k] * step[k]) % slots] >= 0:
                turn[k] += 1
            table[at] = k
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its MD5, modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def table_frame(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard): ``slots`` rows, so its size is known beforehand."""
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(fill_table(shards, slots))], "slot int, shard string")


def assign_shards(df: DataFrame, key: str = "doc_id", shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """df with the columns slot and shard (columns of these names are replaced). No shuffle: the table is broadcast."""
    df = df.drop("slot", "shard").withColumn("slot", slot_of(df[key], slots))
    return df.join(F.broadcast(table_frame(df.sparkSession, shards, slots)), "slot").select(*df.columns, "shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards=SHARDS, slots: int = SLOTS, files: int = 8) -> None:
    """Parquet under path/shard=.../, each shard dealt to ``files`` tasks by slot so that none holds a whole shard."""
    out = assign_shards(df, key, shards, slots)
    out.repartition(len(shards) * files, "shard", F.pmod(F.xxhash64(F.col(key)), F.lit(files))).write.partitionBy("shard").parquet(path)
