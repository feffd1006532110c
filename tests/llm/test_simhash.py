import numpy as np
import xxhash
from llm.odd import no_documents, odd_documents

from holdwright.llm import simhash


def brute(rows, radius=4):
    prints = {}
    out = []
    for i, text in rows:
        w = (text or "").encode().lower()
        words = [x for x in __import__("re").split(rb"[\x20\x09-\x0D]+", w) if x]
        grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        out.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    n = len(out)
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fp = np.array([f for _, f in out], np.uint64)
    for a in range(n):
        for b in np.flatnonzero(np.bitwise_count(fp[a] ^ fp) <= radius):
            parent[root(a)] = root(int(b))
    least = {}
    for k, (i, _) in enumerate(out):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, f"{f:016x}", least.get(root(k))) for k, (i, f) in enumerate(out)), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(simhash.near_duplicates(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd(spark):
    docs = odd_documents(spark)
    assert got(simhash.near_duplicates(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 1, 4, 6, 8, 9, 10]


def test_tiles_by_blocks(monkeypatch, spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.int64)
    fps = np.unique(np.concatenate([base ^ (np.int64(1) << rng.integers(0, 62, 40)) for _ in range(12)] + [base]))
    monkeypatch.setattr(simhash, "TILE", (16, 16))
    edges = simhash.fingerprint_links(spark.createDataFrame([(int(x),) for x in fps], "fp long"))
    found = {r.node: r.root for r in simhash.connected_components(edges).collect()}
    u = fps.view(np.uint64)
    label = np.arange(len(u))
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4
    for _ in range(len(u)):
        new = np.array([label[near[k]].min() for k in range(len(u))])
        if (new == label).all():
            break
        label = new
    assert {frozenset(np.flatnonzero(label == k)) for k in set(label)} == {
        frozenset(k for k in range(len(u)) if found.get(int(fps[k]), int(fps[k])) == r) for r in {found.get(int(x), int(x)) for x in fps}
    }


def test_two_texts_under_one_id(spark):
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"other{k}" for k in range(40))
    rows = [(5, a, 1), (5, b, 2), (2, a, 3), (None, a, 4), (None, None, 5), (5, b, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = simhash.drop_near_duplicates(docs.coalesce(1))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(2, a, 3), (5, b, 2), (None, None, 5)]
