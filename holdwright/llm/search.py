"""Ranked lexical search, reversed: the documents stream past the items.

The items' terms form an inverted index, which is broadcast; each document's term counts go through it
once, and every task keeps the best documents of each item in a bounded heap. Heaps are merged
by item in two rounds, so that no task meets all tasks' heaps.

A term is a run of letters and digits of ASCII and of all other characters beyond it, A-Z lower-cased.
Texts are read once: the first pass leaves each document's length and its counts of the items' terms in the shared
folder; corpus statistics come from those rows, and so do the scores. The index is cut in blocks of at most
``INDEX`` terms of items (an item is never cut), which go one after the other, so what is broadcast is
bounded however many items there are.

Scores are exact 64-bit integers. With N documents of one term or more, L terms in them, n in one, df documents that hold a
term, tf occurrences in a document: w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 10 + (90 * n * N) div L,
and a document's score sums w * ((10^9 * tf) div (1000 * tf + 8 * m)) over the item's terms, once each.

Defined results: null texts have no terms, and a document or item without terms appears nowhere; documents that
repeat an id or a text are ranked each on its own; items that share an id are items of their own (each
with ranks from 1); equal scores go by ascending document id, null ids last; no items or no documents give
no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, materialize

TOP = 10
#: Terms of items in a block of the index, about; an item with more is a block of its own.
INDEX = 1 << 18
#: Scores that are held at once: documents of a batch times the block's items.
HELD = 1 << 21
#: Tasks' heaps are first merged in so many parts of an item.
MERGE = 64
#: Bytes of a term to themselves, A-Z to a-z, all others to a space.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM).split()


def _each(df: DataFrame, f, schema: str) -> DataFrame:
    """f on the values of each Arrow batch's columns, one by one, giving lists for the new columns."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = f(*[(x.as_py() for x in c) for c in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _indexes(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, dict[bytes, int], np.ndarray, np.ndarray]]:
    """Blocks of the items: their ids, the number of each term, and per term (first, item) its items."""
    kind = items.schema[id_col].dataType.simpleString()
    cut = _each(
        items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")),
        lambda ids, texts: (list(ids), [sorted(set(terms(t))) for t in texts]),
        f"id {kind}, terms array<binary>",
    )
    ids, lists, held = [], [], 0

    def close():
        number = {t: k for k, t in enumerate(dict.fromkeys(t for x in lists for t in x))}
        item = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
        term = np.array([number[t] for x in lists for t in x], np.int64)
        return ids, number, np.searchsorted(np.sort(term), np.arange(len(number) + 1)), item[np.argsort(term, kind="stable")]

    for r in cut.filter("size(terms) > 0").toLocalIterator():
        if ids and held + len(r["terms"]) > INDEX:
            yield close()
            ids, lists, held = [], [], 0
        ids.append(r["id"])
        lists.append([bytes(t) for t in r["terms"]])
        held += len(lists[-1])
    if ids:
        yield close()


def counted(docs: DataFrame, number, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf) of each document with a term: the terms that the index has, by their numbers."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(ids: Iterator, texts: Iterator) -> tuple:
        out: tuple[list, ...] = ([], [], [], [])
        known = number.value
        for i, text in zip(ids, texts, strict=True):
            found = terms(text)
            tf = Counter(found)
            here = [(known[t], tf[t]) for t in tf.keys() & known.keys()] if len(tf) < len(known) else [(k, tf[t]) for t, k in known.items() if t in tf]
            for col, x in zip(out, (i, len(found), [k for k, _ in here], [c for _, c in here]), strict=True):
                col.append(x)
        return out

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _each(read, count, f"id {kind}, n long, terms array<int>, tf array<int>").filter("n > 0")


def scores(terms: np.ndarray, tf: np.ndarray, of: np.ndarray, m: np.ndarray, weight: np.ndarray, first: np.ndarray, item: np.ndarray, items: int) -> np.ndarray:
    """A batch's scores (document by item): each count's value goes to all items of its term."""
    tf = tf.astype(np.int64)
    value = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
    out = np.zeros(len(m) * items, np.int64)
    many = first[terms + 1] - first[terms]
    at = np.repeat(first[terms] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    np.add.at(out, np.repeat(of, many) * items + item[at], np.repeat(value, many))
    return out.reshape(len(m), items)


def _search(docs: DataFrame, index: tuple, number: int, top: int, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score): the best documents of a block's items."""
    ids, known, first, item = index
    spark, items = docs.sparkSession, len(ids)
    share = spark.sparkContext.broadcast(known)
    rows = materialize(counted(docs, share, id_col, text_col), "term-counts")
    stats = rows.agg(F.count("n"), F.sum("n")).first()
    n_docs, n_terms = stats[0], stats[1] or 1
    held = rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row for each term of the block at most
    df = np.zeros(len(known), np.int64)
    df[[r["t"] for r in held]] = [r["count"] for r in held]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((weight, first, item))
    kind = docs.schema[id_col].dataType.simpleString()
    step = max(1, HELD // items)
    arrow = arrow_schema(f"item int, id {kind}, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, item = shared.value
        heaps: list[list[tuple]] = [[] for _ in range(items)]
        least = np.zeros(items, np.int64)  # the score that a full heap ends with

        def shrink(k: int) -> None:
            heaps[k] = sorted(heaps[k])[:top]
            if len(heaps[k]) == top:
                least[k] = -heaps[k][-1][0]

        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                many = part.column(2).value_lengths().to_numpy()
                of = np.repeat(np.arange(part.num_rows), many)
                m = np.array([10 + 90 * n * n_docs // n_terms for n in part.column(1).to_pylist()], np.int64)
                found = scores(part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(), of, m, weight, first, item, items)
                who = part.column(0).to_pylist()
                d, k = np.nonzero((found > 0) & (found >= least))
                order = np.argsort(k, kind="stable")
                d, k, s = d[order], k[order], found[d, k][order]
                for begin, end in zip(*_runs(k), strict=True):
                    j, score = int(k[begin]), s[begin:end]
                    if end - begin > top:  # what lies below the batch's own tenth can't stay
                        keep = score >= -np.partition(-score, top - 1)[top - 1]
                        docs, score = d[begin:end][keep], score[keep]
                    else:
                        docs = d[begin:end]
                    heaps[j] += [(-x, who[i] is None, who[i]) for x, i in zip(score.tolist(), docs.tolist(), strict=True)]
                    shrink(j)
        flat = [(j, i, -x) for j, h in enumerate(heaps) for x, _, i in h]
        cols = list(zip(*flat, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(cols, arrow, strict=True)], schema=arrow)

    best = rows.mapInArrow(run, f"item int, id {kind}, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for key in (["item", F.pmod(F.xxhash64("id"), F.lit(MERGE))], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("rank") <= top)
    return best.withColumn("block", F.lit(number))


def _runs(k: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal numbers begin and end."""
    begins = np.flatnonzero(np.diff(k, prepend=-1)).tolist() if len(k) else []
    return begins, [*begins[1:], len(k)] if begins else []


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's best documents: item id, rank (from 1), document id, score."""
    kind = items.schema[item_col].dataType.simpleString()
    spark, out = docs.sparkSession, None
    for number, index in enumerate(_indexes(items, item_col, item_text)):
        names = spark.createDataFrame(list(enumerate(index[0])), f"item int, name {kind}")
        found = _search(docs, index, number, top, id_col, text_col).join(names, "item")
        found = found.select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"{item_col} {kind}, rank int, {id_col} {docs.schema[id_col].dataType.simpleString()}, score long")
    return out
