import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.odd import no_documents, odd_documents

from holdwright.llm import queries, wavelet


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=1500), st.integers(0, 80))
def test_against_a_list(ids, symbol):
    a = np.array(ids, np.uint32)
    m, docs, starts = wavelet.read_shard(wavelet.write_shard(a, [3, None], np.array([0, len(ids) // 2, len(ids)])))
    assert docs == [3, None] and starts.tolist() == [0, len(ids) // 2, len(ids)]
    assert m.decode().tolist() == ids
    assert m.access(np.arange(len(ids))).tolist() == ids
    at = [k for k, x in enumerate(ids) if x == symbol]
    assert [m.select(symbol, k) for k in range(len(at) + 1)] == [*at, -1]
    lo, hi = len(ids) // 3, len(ids) - len(ids) // 4
    assert m.count(symbol, lo, hi) == ids[lo:hi].count(symbol)


def expected(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries._tokenizer())
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=str)


def test_documents(spark, sf, monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 3000)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(queries.op7_token_ids(spark, sf)) == expected(rows)


def test_odd(spark):
    docs = odd_documents(spark)
    extra = spark.createDataFrame(
        [(20, "A<|endoftext|>b <|STARTOFTEXT|> it's IT'S été. don't!! a b c\x0bd\x1ce 12,3. ... Don't, stop."), (21, "Σας ΑΣ. İx, Ǆ K")], "doc_id long, text string"
    )
    docs = docs.unionByName(extra, allowMissingColumns=True)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(wavelet.round_trip(docs, queries._tokenizer())) == expected(rows)
    assert wavelet.round_trip(no_documents(spark), queries._tokenizer()).count() == 0
