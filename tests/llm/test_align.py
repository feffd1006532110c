"""Alignment of ids against plain loops over token ends, and the quick encoder against the full one."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from holdwright.llm import align
from tests.llm.odd import no_documents, odd_documents

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def encoders():
    full = Tokenizer.from_file(BYTES)
    full.encode_special_tokens = True
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}
    entry = {i: bytes(of[c] for c in w) for w, i in json.loads(full.to_str())["model"]["vocab"].items() if i != 50256}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    return lambda t: (full.encode(f" {t}", add_special_tokens=False).ids, entry), lambda t: (model.encode(t), {i: piece(i) for i in model.encode(t)})


def brute(encoders, docs):
    laid, pairs = [], Counter()
    for i, text in docs:
        groups = None
        if text:
            sides = [f(text) for f in encoders]
            if all(b"".join(of[t] for t in ids) == f" {text}".encode() for ids, of in sides):
                ends = []
                for ids, of in sides:
                    at, stops = 0, {}
                    for k, t in enumerate(ids):
                        at += len(of[t])
                        stops[at] = k + 1
                    ends.append(stops)
                shared = sorted(set(ends[0]) & set(ends[1]))
                groups, a, b = [], 0, 0
                for x in shared:
                    groups.append((sides[0][0][a : ends[0][x]], sides[1][0][b : ends[1][x]]))
                    a, b = ends[0][x], ends[1][x]
                pairs.update((x[-1], y[-1]) for x, y in groups)
        laid.append((i, groups))
    top = Counter()
    for (_, b), n in pairs.items():
        top[b] = max(top[b], n)
    out = []
    for i, groups in laid:
        if groups is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x[-1], y[-1]) for x, y in groups]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n = [sum(map(len, s)) for s in zip(*groups, strict=True)]
        best = sum(pairs[p] == top[p[1]] for p in links)
        out.append((i, *n, len(groups), len(links), best, sum(pairs[p] for p in links), hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", *COLS).collect()), key=str)


STRANGE = ["<|endoftext|> <s> </s> <0x41>", "a▁b", "  two  spaces \n\n\n tabs\t\t.", "中文字符 и русский\U0001f600\U0001f600", "\x00nul", "don't I'LL 12345 67", " ", "x", "é é   　"]


def test_odd(spark, encoders):
    docs = odd_documents(spark).unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(STRANGE)], "doc_id long, text string"), allowMissingColumns=True).repartition(4)
    assert rows(align.align(docs, BYTES, PIECES)) == brute(encoders, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows(align.align(no_documents(spark), BYTES, PIECES)) == []


@pytest.mark.parametrize("limits", [{}, {"BLOCK_DOCS": 3}, {"BLOCK_LINKS": 500, "MEMO": 5}, {"BLOCK_BYTES": 1000, "CHUNK": 100}])
def test_given_documents(spark, sf, encoders, limits, monkeypatch):
    # the limits hold in tasks only if they are part of what is sent there
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 4 = 1").select("doc_id", "text")
    want = brute(encoders, [(r["doc_id"], r["text"]) for r in docs.collect()])
    for k, v in limits.items():
        monkeypatch.setattr(align, k, v)
    assert rows(align.align(docs, BYTES, PIECES)) == want
    a, b = align.ByteTokens(BYTES), align.PieceTokens(PIECES)
    if limits:
        import pyarrow as pa

        local = docs.toArrow().combine_chunks().to_batches()
        blocks = list(align._blocks(iter(local), a, b, 7))
        assert len(blocks) > 3 and [x.number for x in blocks] == list(range(7, 7 + len(blocks)))
        memo = align.Memo(a, b)
        told = {r["id"]: r for x in blocks for r in x.rows(a, b, memo) if "id" in r}
        assert {i: (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) for i, r in told.items()} == {w[0]: (w[1], w[2], w[3], w[7]) for w in want}
        assert isinstance(local[0], pa.RecordBatch)


def test_quick_encoder():
    quick, full = align.ByteTokens(BYTES), align.ByteTokens(BYTES)
    assert quick.quick is not None
    full.quick = None
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}1 .{chr(c)}. {chr(c)}\n  {chr(c)}x" for c in range(k, k + 64)) for k in range(0, 0x3000, 64)]
    texts += [" " * 5000, "\n" * 999, "a" * 9999, " x" * 3000, "<|endoftext|>"]
    assert all(x.tolist() == y.tolist() for x, y in zip(quick.encode(texts), full.encode(texts), strict=True))


def test_texts_are_aligned_together(sf):
    """Many texts at once, in slices of any size, give what each gives alone; a block's row has its pairs and nothing for each window."""
    import pyarrow.parquet as pq

    a, b = align.ByteTokens(BYTES), align.PieceTokens(PIECES)
    memo, texts = align.Memo(a, b), [*STRANGE[1:3], "a", *pq.read_table(f"{sf}/documents.parquet", columns=["text"]).column(0).to_pylist()[:30]]
    docs = [(x, y) for t, x, y in zip(texts, a.encode(texts), b.encode(texts), strict=True) if align.spelled(a, x, f" {t}".encode()) and align.spelled(b, y, f" {t}".encode())]
    assert len(docs) > 20
    sha, groups, pairs = align.aligned(a, b, memo, docs)
    alone = [align.aligned(a, b, memo, [d]) for d in docs]
    assert sha == [x[0][0] for x in alone] and groups.tolist() == [x[1][0] for x in alone] and pairs.tolist() == [p for x in alone for p in x[2].tolist()]
    block = align.Block(3)
    block.docs = [(k, *d) for k, d in enumerate(docs)] + [(99, None, None)]
    *told, last = block.rows(a, b, memo)
    assert [int(r["times"].sum()) for r in told[:-1]] == groups.tolist() and told[-1]["n_groups"] == 0
    assert set(last) == {"block", "a", "b", "n"} and last["n"].sum() == groups.sum()
    assert [r for r in align.Block(4).rows(a, b, memo)][0]["a"].tolist() == []
