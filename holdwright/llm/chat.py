"""Chat formatting by rotating the perspective.

A dialogue is rendered once for every participant: that speaker is the assistant, the
others are users with names, system turns stay system turns, and the mask covers
what the assistant says. Turns are in order of ``turn`` (nulls first), then of role
and text.

A dialogue comes in parts of ``PART`` turns each, with their place in the whole, so that one of
any length is never gathered into one row; nearly every dialogue is one part. Turns get their numbers
by ranges of that order: the rows of a range are numbered within it, and begin where the ranges before it end.

Defined results: a null turn comes before turn 0; a null role is the participant ``unknown``; a
null text is empty; a null conversation id is a conversation; the control marks'
opening ``<|`` is written ``< |`` where a text or a name has it; repeated rows are
turns of their own; a dialogue of system turns alone has no perspective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SYSTEM = "system"
PART = 256
END = "<|end|>\n"


def _numbered(t: DataFrame) -> DataFrame:
    """t with part: the turn's number in its conversation (by turn, role, text; equal rows by a number of their own) over PART."""
    order = ["turn", "role", "text", "own"]
    dealt = t.withColumn("own", F.monotonically_increasing_id()).repartitionByRange("conv", *order)
    dealt = materialize(dealt.withColumn("lot", F.spark_partition_id()), "turns")
    sizes = dealt.groupBy("conv", "lot").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv").alias("k_conv"), F.col("lot").alias("k_lot"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    placed = dealt.withColumn("rn", F.row_number().over(Window.partitionBy("conv", "lot").orderBy(*order)))
    placed = placed.join(sizes, F.col("conv").eqNullSafe(F.col("k_conv")) & (F.col("lot") == F.col("k_lot")))
    return placed.select(*t.columns, F.floor((F.col("at") + F.col("rn") - 1) / PART).cast("long").alias("part"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, perspective and part: conv_id, perspective, part,
    n_turns, start (characters of the dialogue before the part), text, mask (spans
    [start, stop) of the whole dialogue that the assistant says, END included).
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    t = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        safe(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )
    speakers = t.filter(F.col("role") != SYSTEM).groupBy("conv", "role").agg(F.count("role").alias("said")).select(F.col("conv").alias("c"), F.col("role").alias("perspective"))
    # A part's turns are gathered once; the perspectives then only render them.
    parts = _numbered(t).groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    seen = parts.join(speakers, F.col("conv").eqNullSafe(F.col("c"))).drop("c")

    def piece(x):
        mine = x["role"] == F.col("perspective")
        head = F.when(mine, F.lit("<|assistant|>\n")).when(x["role"] == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user "), safe(x["role"]), F.lit("|>\n")))
        return F.struct(head.alias("head"), F.concat(x["text"], F.lit(END)).alias("body"), mine.alias("mine"))

    def walk(acc, p):
        begin = acc["at"] + F.length(p["head"]).cast("long")
        stop = begin + F.length(p["body"]).cast("long")
        spans = F.when(p["mine"], F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), stop.alias("stop"))))).otherwise(acc["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    seen = seen.withColumn("pieces", F.transform("turns", piece)).withColumn("walk", F.aggregate("pieces", none, walk))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    seen = seen.select("conv", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), F.col("walk.at").alias("chars"), F.col("walk.spans").alias("mask"))
    before = Window.partitionBy("conv", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    mask = F.transform("mask", lambda s: F.struct((s["start"] + F.col("start")).alias("start"), (s["stop"] + F.col("start")).alias("stop")))
    return seen.select(F.col("conv").alias(conv_col), "perspective", "part", "n_turns", "start", "text", mask.alias("mask"))
