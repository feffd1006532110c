"""Reversed search against plain loops over every document and item."""

import math
import re

import pytest

from holdwright.llm import search
from tests.llm.odd import no_documents, odd_documents

ITEMS = "item_id long, text string, doc_id string, rank string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top=10):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    out = []
    for item, text in items:
        found = []
        for i, t in held:
            m, score = 10 + 90 * len(t) * n_docs // n_terms, 0
            for term in set(terms(text)):
                df, tf = sum(term in set(x) for _, x in held), t.count(term)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    texts = ["same words here", "WORDS word1 été", None, "", "...", "nothing_matches qqq", "中文 Σας again again one text", "one"]
    return spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)] + [(1, "a second text, same id", "x", "y")], ITEMS)


@pytest.mark.parametrize("index", [search.INDEX, 1, 6])
def test_odd(spark, items, monkeypatch, index):
    monkeypatch.setattr(search, "INDEX", index)
    docs = odd_documents(spark).repartition(5)
    pairs = lambda df, k: [(r[k], r["text"]) for r in df.collect()]
    assert rows(search.search(docs, items)) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_ties_and_small_tops(spark, items):
    docs = spark.createDataFrame([(k % 40, "same words") for k in range(120)] + [(None, "same words")] * 2, "doc_id long, text string").repartition(7)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()], 3)
    assert rows(search.search(docs, items, top=3)) == want


def test_no_rows(spark, items):
    assert rows(search.search(no_documents(spark), items)) == []
    assert rows(search.search(odd_documents(spark), items.limit(0))) == []


def test_given_tables(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.limit(60).collect()], [(r["item_id"], r["text"]) for r in items.limit(10).collect()])
    assert rows(search.search(docs.limit(60), items.limit(10))) == want
