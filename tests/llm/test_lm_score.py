import math
import re
from collections import Counter

import pytest
from llm.odd import no_documents, odd_documents

from holdwright.llm import lm_score


def words(text):
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]


def brute(rows, corpus=None, order=3, alpha=0.4, min_count=1):
    c = Counter()
    for text in [t for _, t in rows] if corpus is None else corpus:
        w = words(text)
        c.update(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(k for g, k in c.items() if len(g) == 1)
    out = []
    for i, text in rows:
        w, s, backed, single = words(text), 0.0, 0, 0
        for z in range(1, len(w) + 1):
            full = min(z, order)
            single += c[tuple(w[z - full : z])] == 1
            for n in range(full, 0, -1):
                g = tuple(w[z - n : z])
                if n == 1 or c[g] >= min_count:
                    s += math.log(max(c[g], 1) / (c[g[:-1]] if n > 1 else max(total, 1))) + (full - n) * math.log(alpha)
                    backed += n < full
                    break
        out.append((i, len(w), backed, single, s))
    return sorted(out, key=lambda r: (str(r[0]), r[4]))


def same(df, want):
    got = sorted(((r.doc_id, r.n_words, r.n_backoff, r.n_single, r.score) for r in df.collect()), key=lambda r: (str(r[0]), r[4]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(abs(g[4] - w[4]) < 1e-5 * max(1, abs(w[4])) for g, w in zip(got, want, strict=True))


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize(("order", "min_count"), [(3, 1), (3, 2), (1, 1), (2, 2), (4, 3)])
def test_documents(spark, sf, order, min_count):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    same(lm_score.score(docs, order=order, min_count=min_count), brute(rows_of(docs), order=order, min_count=min_count))


def test_many_blocks_and_parts(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3, "doc_id")
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 3000)
    monkeypatch.setattr(lm_score, "PART_GRAMS", 20_000)
    same(lm_score.score(docs), brute(rows_of(docs)))


def test_model_of_another_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some, rest = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 <> 0")
    want = brute(rows_of(some), [t for _, t in rows_of(rest)])
    assert sum(w[2] for w in want) > 1000
    same(lm_score.score(some, rest), want)
    same(lm_score.score(some, no_documents(spark)), brute(rows_of(some), []))


def test_odd(spark):
    docs = odd_documents(spark)
    same(lm_score.score(docs), brute(rows_of(docs)))
    two = spark.createDataFrame([(5, "a b c"), (5, "d e"), (5, "a b c"), (2, "a b c")], "doc_id long, text string")
    same(lm_score.score(two), brute(rows_of(two)))
    same(lm_score.score(two.selectExpr("cast(doc_id as string) doc_id", "text")), brute([(str(i), t) for i, t in rows_of(two)]))
    assert lm_score.score(no_documents(spark)).count() == 0


def test_many_empty_texts(spark, monkeypatch):
    """Blocks close by documents, and null, empty and blank texts score 0 in blocks of their own or beside others."""
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 16)
    rows = [(k, [None, "", "  \n"][k % 3]) for k in range(300)] + [(k, "a b a b c") for k in range(300, 310)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm_score.score(docs), brute(rows_of(docs)))


def test_blocks_close_by_documents(monkeypatch):
    import pyarrow as pa
    from pyspark import TaskContext

    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 16)
    monkeypatch.setattr(TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 2})())
    batch = pa.RecordBatch.from_pydict({"id": list(range(100)), "text": [b""] * 100})
    found = list(lm_score._blocks(iter([batch])))
    assert [len(ids) for _, ids, _ in found] == [16] * 6 + [4] and [n - (2 << 32) for n, _, _ in found] == list(range(7))


def test_a_block_takes_little_room(sf):
    """What travels of a block beside its n-grams is less than half of 4 bytes a word and 8 a kind, and reads back as it was."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    text = pq.read_table(f"{sf}/documents.parquet", columns=["text"]).column(0)
    index, words = {}, []
    for t in [*text.to_pylist(), "", None, " \n "]:
        found = (t or "").encode().lower().split()
        words.append(np.array([index.setdefault(w, len(index)) for w in found], np.int32))
    block = lm_score.Block(np.concatenate(words), np.array([len(w) for w in words]), list(index))
    laid = block.laid()
    assert sum(map(len, laid.values())) < (4 * len(block.words) + 8 * len(index)) / 2
    again = lm_score.Block.read(**laid)
    assert all((getattr(block, c) == getattr(again, c)).all() for c in ("words", "sizes", "digests", "place")) and block.kinds == again.kinds
    none = lm_score.Block.read(**lm_score.Block(np.array([], np.int32), np.array([0, 0]), []).laid())
    assert len(none.words) == 0 and none.sizes.tolist() == [0, 0] and isinstance(pa.array(none.sizes), pa.Int64Array)
    for x in ([], [0], [255, 256], list(range(70_000)), [2**63, 1, 2**52 - 1]):
        assert lm_score.unpack(lm_score.pack(np.array(x, np.uint64))).tolist() == x
