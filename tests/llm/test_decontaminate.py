import hashlib
import re

from llm.odd import no_documents, odd_documents

from holdwright.llm import decontaminate
from holdwright.llm.decontaminate import contamination, drop_contaminated, remove_spans

COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=13):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                for i in grams.get(tuple(w[k : k + n]), ()):
                    hit |= set(range(k, k + n))
                    ids |= {str(i)} if i is not None else set()
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=str)


def pairs(df, a, b):
    return [tuple(r) for r in df.select(a, b).collect()]


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = got(contamination(docs, bench))
    assert rows == brute(pairs(docs, "doc_id", "text"), pairs(bench, "item_id", "text"))
    assert any(r[-1] for r in rows)


def test_odd(spark, monkeypatch):
    docs = odd_documents(spark)
    items = [
        (1, "words HERE again"), (2, None), (3, ""), (4, "ONE"), (None, "same words"), (5, "été istanbul ΣΑΣ"), (5, "words here again"),
        (7, "1234 5678"), (8, "ÉTÉ İstanbul ΣΑΣ 中文"), (9, "?!"),
    ]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, id long")
    want = brute(pairs(docs, "doc_id", "text"), items)
    assert got(contamination(docs, bench)) == want
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    assert got(contamination(docs, bench)) == want
    assert got(contamination(docs, bench.limit(0))) == brute(pairs(docs, "doc_id", "text"), [])
    assert contamination(no_documents(spark), bench).count() == 0
    dropped = drop_contaminated(docs, bench)
    assert dropped.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in dropped.collect()) == [0, 1, 2, 3, 4, 5]
    cut = {r.doc_id: r.text for r in remove_spans(docs.filter("doc_id in (7, 8, 2)"), bench).collect()}
    assert cut == {7: "and again", 8: "", 2: ""}


def test_short_item_at_the_end_of_a_text(spark, monkeypatch):
    short = "a b c d e"
    items = [(1, short), (2, " ".join(f"q{k}" for k in range(13))), (3, "a b c d e f g")]
    rows = [(1, " ".join(f"w{k}" for k in range(195)) + " " + short), (2, short), (3, "x " + short + " f"), (4, "a b c"), (5, short + " f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert want[0][2] == 5 and not want[0][-1]
    for most in (decontaminate.MAX_BROADCAST, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST", most)
        assert got(contamination(docs, bench)) == want
        assert all(s.stop <= r.n_words for r in contamination(docs, bench).collect() for s in r.spans)
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [1, 4]


def test_two_texts_under_one_id(spark):
    docs = spark.createDataFrame([(5, "a b c d e"), (5, "clean text here"), (None, "a b c d e"), (None, "clean"), (7, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert sorted(map(tuple, drop_contaminated(docs, bench).collect()), key=str) == [(5, "clean text here"), (7, None), (None, "clean")]
    assert sorted(map(tuple, remove_spans(docs, bench).collect()), key=str) == [(5, ""), (5, "clean text here"), (7, None), (None, ""), (None, "clean")]
