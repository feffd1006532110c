"""Mixing sources to target weights by hierarchical budgets.

A token budget flows down a tree of domains, their languages and their sources, in
proportion to weights. A node can take at most ``max_epochs`` times the tokens
below it. What a child can't take goes to its siblings by their weights; only what
all the children together can't take is left to the parent's siblings. A leaf's
budget is spent on whole seeded epochs over its documents, then on a prefix, by
tokens, of one more epoch in its own seeded order.

Defined results: a null domain, language or source is the label ``unknown``; null
and empty texts have no tokens, cost nothing, and are taken with every whole epoch
and where they precede the cut in the last one; repeated rows have the same place in
an order and are taken or left together; a weight of zero takes no tokens; an empty table
gives no rows. Columns of the input that clash with working names are unaffected.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

LEVELS = ("domain", "lang", "source")
DOMAIN_WEIGHTS = {"domain-0": 0.4, "domain-1": 0.3, "domain-2": 0.2, "domain-3": 0.1}
LANG_WEIGHTS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}
OTHER = 0.05
#: Share of all tokens that is budgeted, and the epochs a leaf may be used for.
SHARE, MAX_EPOCHS, SEED = 0.8, 3, "mix-1"
#: A leaf's order is cut into 16**k parts by hash, k such that a leaf of all documents has about PART in each.
PART, MOST_DIGITS = 256, 5


def domain_of(source: Column) -> Column:
    """The domain of a source: the number that ends its name, modulo four."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    number = F.when(digits != "", digits).otherwise("0").cast("int")
    return F.concat(F.lit("domain-"), (number % 4).cast("string"))


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def _weight(label: Column, weights: Mapping[str, float] | None) -> Column:
    if weights is None:
        return F.lit(1.0)
    out = F.lit(float(weights.get("*", OTHER)))
    for name, w in weights.items():
        out = F.when(label == name, F.lit(float(w))).otherwise(out)
    return out


def _fill(nodes: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """Column budget -> alloc: the parent's budget dealt to its children by weight, none above cap.

    In order of cap / weight a child is full as long as its cap is below its share of
    what the earlier ones left; the others share the rest by weight.
    """
    n = nodes.withColumn("weight", weight).withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    order = Window.partitionBy(*parent).orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parent)
    n = n.withColumn("caps", F.sum("cap").over(order)).withColumn("weights", F.sum("weight").over(order)).withColumn("all", F.sum("weight").over(whole))
    fits = (F.col("weight") > 0) & (F.col("ratio") * (F.col("all") - F.col("weights")) + F.col("caps") <= F.col("budget"))
    n = n.withColumn("full", fits)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    share = F.when((F.col("weight") > 0) & (rest > 0), left * F.col("weight") / rest).otherwise(F.lit(0.0))
    alloc = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return n.withColumn("alloc", alloc).drop("weight", "ratio", "caps", "weights", "all", "full", "budget")


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, float] | None], share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """leaves (domain, lang, source, total) with budget: whole tokens for each leaf."""
    nodes = leaves.withColumn("cap", F.col("total") * max_epochs)
    top = nodes.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("total").alias("total"))
    top = top.withColumn("budget", F.sum("total").over(Window.partitionBy(F.lit(0))) * F.lit(share)).drop("total").withColumn("root", F.lit(0))
    top = _fill(top, ["root"], _weight(F.col("domain"), weights.get("domain"))).select("domain", F.col("alloc").alias("budget"))
    mid = nodes.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(top, "domain")
    mid = _fill(mid, ["domain"], _weight(F.col("lang"), weights.get("lang"))).select("domain", "lang", F.col("alloc").alias("budget"))
    low = _fill(nodes.join(mid, ["domain", "lang"]), ["domain", "lang"], _weight(F.col("source"), weights.get("source")))
    return low.select(*LEVELS, "total", F.floor(F.round("alloc", 6)).cast("long").alias("budget"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, float] | None] | None = None,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The chosen documents: one row per document and epoch, as columns
    (doc: struct of docs' columns, epoch, tokens, domain, lang, source).

    Two passes over the text: the tokens of each part of each leaf's orders, then the
    choice. A leaf's parts are slices of a hash, so a hot leaf has as many rows in each
    part as any task can take, and only the parts that hold a cut are put in order.
    """
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS, "source": None} if weights is None else weights
    label = lambda c: F.coalesce(c, F.lit("unknown"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        label(domain_of(docs["source"])).alias("domain"),
        label(docs["lang"]).alias("lang"),
        label(docs["source"]).alias("source"),
        tokens_of(docs[text_col]).alias("tokens"),
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("name"),
    )
    place = lambda epoch: F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), "name").cast("binary"))
    digits = min(max(1, math.ceil(math.log(max(docs.count() / PART, 1), 16))), MOST_DIGITS)
    # The part of a document in every epoch's order, so that one pass serves whichever epoch is cut.
    parts = rows.select(*LEVELS, "tokens", F.posexplode(F.array(*[F.substring(place(e), 1, digits) for e in range(max_epochs)])).alias("epoch", "part"))
    parts = materialize(parts.groupBy(*LEVELS, "epoch", "part").agg(F.sum("tokens").alias("tokens")), "mix-parts")
    totals = parts.filter("epoch = 0").groupBy(*LEVELS).agg(F.sum("tokens").alias("total"))
    budget = leaf_budgets(totals, weights, share, max_epochs)
    whole = F.when(F.col("total") > 0, F.least(F.floor(F.col("budget") / F.greatest("total", F.lit(1))), F.lit(max_epochs))).otherwise(F.lit(0)).cast("int")
    budget = budget.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("total"))
    last = parts.join(budget, list(LEVELS)).filter("epoch = whole")
    run = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("upto", F.sum("tokens").over(run)).filter("upto > rest")
    cut = last.groupBy(*LEVELS).agg(F.min(F.struct("part", (F.col("upto") - F.col("tokens")).alias("before"))).alias("cut"))
    plan = materialize(budget.join(cut, list(LEVELS), "left").select(*LEVELS, "whole", "rest", F.col("cut.part").alias("cut"), F.col("cut.before").alias("before")), "mix-plan")

    rows = rows.join(plan, list(LEVELS))
    choose = F.lit(None).cast("string")
    for e in range(max_epochs):
        choose = F.when(F.col("whole") == e, place(e)).otherwise(choose)
    rows = rows.withColumn("place", choose)
    part = F.substring("place", 1, digits)
    sure = F.when(F.col("place").isNull(), F.col("whole")).otherwise(F.col("whole") + F.when((part < F.col("cut")) | F.col("cut").isNull(), 1).otherwise(0))
    out = ["doc", "epoch", "tokens", *LEVELS]
    full = rows.withColumn("sure", sure).filter("sure > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("sure") - 1))).select(*out)
    edge = rows.filter(part == F.col("cut"))
    within = Window.partitionBy(*LEVELS).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.sum("tokens").over(within) + F.col("before")).filter("upto <= rest").withColumn("epoch", F.col("whole")).select(*out)
    return full.unionByName(edge)
