import numpy as np

from holdwright.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, row long, n_links string"


def brute(rows, cosine=0.98):
    n = len(rows)
    unit = []
    for _, e, _l in rows:
        x = None if not e or any(v is None for v in e) else np.array(e, np.float64)
        ok = x is not None and np.isfinite(x).all() and (x != 0).any()
        x = x / np.abs(x).max() if ok else None
        unit.append(x / np.sqrt((x * x).sum()) if ok else None)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            same = a != b and rows[a][2] is not None and rows[a][2] == rows[b][2]
            link[a, b] = same and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine
    label = list(range(n))
    for _ in range(n):
        new = [min(label[b] for b in range(n) if b == a or link[a, b]) for a in range(n)]
        if new == label:
            break
        label = new
    ids = {}
    for a in range(n):
        if rows[a][0] is not None:
            ids[label[a]] = min(rows[a][0], ids.get(label[a], rows[a][0]))
    return sorted((str(rows[a][0]), int(link[a].sum()), str(ids.get(label[a])), ids.get(label[a]) in (None, rows[a][0])) for a in range(n))


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def test_embeddings(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in v.collect()]
    assert got(embed_dedup.near_duplicates(v)) == brute(rows)


def test_odd(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "TILE", 8)
    rng = np.random.default_rng(3)
    a = rng.standard_normal(16)
    near = [(i, [float(x) for x in a + rng.standard_normal(16) * 0.05], 1) for i in range(40)]
    odd = [
        (100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [float("nan")] * 16, 1), (104, [1.0, None] * 8, 1), (105, [float("inf")] * 16, 1),
        (106, [float(x) for x in a], None), (107, [float(x) for x in a], 2), (107, [float(x) for x in a], 2), (None, [float(x) for x in a], 2),
        (108, [1.0, 2.0], 1), (109, [2.0, 4.0], 1), (None, [-1.0, 4.0], 3), (110, [3.0], 4), (111, [9.0], 4),
    ]
    rows = near + odd
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    as_float = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], lab) for i, e, lab in rows]
    assert got(embed_dedup.near_duplicates(df)) == brute(as_float)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_extreme_components(spark):
    rows = [(k, [s * x for x in v], 1) for k, (s, v) in enumerate([(1e160, [1, 2, 3, 4])] * 3 + [(1e-170, [1, 2, 3, 4]), (1e-170, [4, 3, 2, 1]), (1e-310, [4, 3, 2, 1]), (1e300, [4.0, -3, 2, 1])])]
    out = got(embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    assert out == brute(rows) and [x[1] for x in out] == [3, 3, 3, 3, 1, 1, 0]


def test_no_pair_is_lost():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    d = rng.standard_normal((300, 64))
    d -= (d * a).sum(1, keepdims=True) * a
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    b = 0.9801 * a + np.sqrt(1 - 0.9801**2) * d
    la, lb, _, _ = embed_dedup.tile_links(a, b, False)
    assert (la == 1).all() and (lb == 1).all()
