"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned over training text.

Words are maximal runs of ASCII letters and digits or non-ASCII characters, with
A-Z lower-cased. A window is ``window`` consecutive words of an item; an item with
fewer words, but not none, is one window. A document word inside an occurrence of
any window is hit.

Defined results: a null or empty text has no words and is clean; an item with a
null text or no words has no windows; hits of an item with a null id count as hits
and the id is left out of the list; repeated rows each get their own result;
columns of the input other than the id and the text stay out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: What stands between words, before A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: An occurrence is looked for where this many of its first words stand.
ANCHOR = 3
#: More windows than this are not put into the plan; their join shuffles instead.
MAX_BROADCAST = 500_000
SPANS = "array<struct<start:int,stop:int>>"


def words(text: Column) -> Column:
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")
    return F.transform(found, ascii_lower)


def item_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (gram, n, anchor, item_id): each window's words joined by a space, their number, the hash of its first words."""
    w = benchmark.select(F.col(item_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - n + 1))
    g = w.select("item_id", "w", n.alias("n"), at.alias("i")).select("item_id", "n", F.slice("w", F.col("i"), F.col("n")).alias("g"))
    return g.select(
        F.array_join("g", " ").alias("gram"), "n", F.xxhash64(F.slice("g", 1, ANCHOR)).alias("anchor"), "item_id"
    ).distinct()


def _gram_of(n: int):
    return lambda i: F.struct(i.alias("i"), F.lit(n).alias("n"), F.array_join(F.slice("w", i, n), " ").alias("gram"))


def _candidates(docs: DataFrame, windows: DataFrame, lengths: list[int], hashes: list[int] | None) -> DataFrame:
    """docs (row, id, w) with found: array<struct<i, n, gram>>, the places where a window may occur."""
    anchors = sorted({min(n, ANCHOR) for n in lengths})
    pieces = []
    for k in anchors:
        key = lambda i, k=k: F.xxhash64(*[F.get("w", i - 1 + j) for j in range(k)])
        fits = [n for n in lengths if min(n, ANCHOR) == k]
        starts = F.sequence(F.lit(1), F.size("w") - min(fits) + 1)
        hit = F.filter(starts, lambda i: key(i).isin(hashes)) if hashes is not None else starts
        hit = F.when(F.size("w") >= min(fits), hit).otherwise(F.array().cast("array<int>"))
        for n in fits:
            # Near the end of a text the shorter windows fit where the longer ones don't.
            inside = hit if n == min(fits) else F.filter(hit, lambda i, n=n: i + n - 1 <= F.size("w"))
            pieces.append(F.transform(inside, _gram_of(n)))
    return docs.withColumn("found", F.concat(*pieces) if len(pieces) > 1 else pieces[0])


def _told(text_col: str) -> Column:
    """What tells texts under one id apart."""
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, told (the SHA-256 of its text), n_words, n_hit, n_items, items_sha256, contaminated, spans.

    spans lists the hit words as array<struct<start, stop>> of word positions, from 1,
    stop inclusive, merged and ascending. contaminated: n_hit > 0 and one_in * n_hit >= n_words.

    One projection over the text keeps, per document, the number of words and the few
    places where the first words of a window stand (an IN over a hash set that goes to
    the tasks with the plan). Only those places meet the windows in a join on the full
    words, which verifies them. The set's size is counted first; above MAX_BROADCAST
    windows every place meets them in a shuffled join.
    """
    found = materialize(item_windows(benchmark, window), "windows")
    lengths = sorted(r.n for r in found.select("n").distinct().collect())
    small = found.count() <= MAX_BROADCAST
    every = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.col(id_col).alias("id"), _told(text_col).alias("told")).alias("id"), words(F.col(text_col)).alias("w"))
    if lengths:
        hashes = [r.anchor for r in found.select("anchor").distinct().collect()] if small else None
        every = _candidates(every, found, lengths, hashes)
    else:
        every = every.withColumn("found", F.array().cast("array<struct<i:int,n:int,gram:string>>"))
    seen = materialize(every.select("row", "id", F.size("w").alias("n_words"), "found"), "scan")
    clean = seen.filter(F.size("found") == 0).select("id", "n_words")
    place = seen.filter(F.size("found") > 0).select("row", "id", "n_words", F.explode("found").alias("f"))
    place = place.select("row", "id", "n_words", "f.i", F.col("f.n").alias("n"), "f.gram")
    grams = found.groupBy("gram", "n").agg(F.collect_set("item_id").alias("items"))
    met = place.join(F.broadcast(grams) if small else grams, ["gram", "n"], "left").filter("items is not null")
    per = met.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("i", "n"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    start = F.array().cast(SPANS)

    def merge(acc, h):
        last = F.element_at(acc, -1)
        new = F.struct(h["i"].alias("start"), (h["i"] + h["n"] - 1).alias("stop"))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], new["stop"]).alias("stop"))
        touches = (F.size(acc) > 0) & (h["i"] <= F.try_element_at(acc, F.lit(-1))["stop"] + 1)
        return F.when(touches, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(new)))

    per = per.select("row", "items", F.aggregate("hits", start, merge).alias("spans"))
    dirty = seen.filter(F.size("found") > 0).select("row", "id", "n_words").join(per, "row", "left").select("id", "n_words", "items", "spans")
    none = clean.select("id", "n_words", F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast(SPANS).alias("spans"))
    both = dirty.unionByName(none)
    spans = F.coalesce("spans", start)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"] + 1).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = both.select("id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"), spans.alias("spans"))
    return out.select(
        F.col("id.id").alias(id_col),
        "id.told",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def _with_verdict(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """docs joined to what was found of rows with their id and text."""
    return docs.join(found, docs[id_col].eqNullSafe(found["__id"]) & (_told(text_col) == found["__told"]), how)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs without those that the rule finds contaminated. Rows that share an id are judged each by its text."""
    found = contamination(docs, benchmark, window, one_in, id_col, text_col).filter("contaminated")
    found = found.select(F.col(id_col).alias("__id"), F.col("told").alias("__told")).distinct()
    return _with_verdict(docs, found, id_col, text_col, "left_anti").select(*docs.columns)


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs with the hit words of contaminated texts cut out: the words that stay, lower-cased, joined by a space.

    Other texts are unchanged.
    """
    found = contamination(docs, benchmark, window, one_in, id_col, text_col).filter("contaminated")
    found = found.select(F.col(id_col).alias("__id"), F.col("told").alias("__told"), F.col("spans").alias("__spans")).dropDuplicates(["__id", "__told"])
    keep = F.filter(words(F.col(text_col)), lambda x, i: ~F.exists("__spans", lambda s: (i + 1 >= s["start"]) & (i + 1 <= s["stop"])))
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.array_join(keep, " "))
    return _with_verdict(docs, found, id_col, text_col, "left").withColumn(text_col, text).select(*docs.columns)
