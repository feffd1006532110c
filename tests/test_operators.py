import math
import random

import pytest
from pyspark.sql import functions as F

from holdwright.operators import aggregate, cluster, dedup, joins, order, rank, reconcile


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_similarity_is_a_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(0, 90))) for _ in range(2))
        assert cluster.lcs(a, b) == lcs(a, b)


def test_similar_pairs_and_clusters(spark):
    r = random.Random(2)
    base = ["acme industrial services", "acme software holdings", "acme health partners of texas", "beta logistics", "beta logistics group"]
    names = sorted({"".join(c for c in b if r.random() > 0.06) for b in base for _ in range(8)} | set(base))
    df = spark.createDataFrame([(n,) for n in names], "name string")
    block = F.element_at(F.split("name", " "), 1)
    key = lambda n: " ".join(sorted(n.lower().split()))
    want = {(a, b) for a in names for b in names if a < b and a.split()[0] == b.split()[0] and 200 * lcs(key(a), key(b)) / (len(key(a)) + len(key(b))) >= 88}
    got = {(x.a, x.b) for x in cluster.similar_pairs(df, "name", block).collect()}
    assert got == want and want
    found = {x["name"]: x.canonical for x in cluster.clusters(df, "name", block, F.col("name")).collect()}
    assert set(found) == set(names) and all(found[a] == found[b] for a, b in want)
    assert all(len(found[n]) >= len(n) for n in names)


def test_similar_pairs_of_repeated_letters(spark):
    names = ["0000000000000000012", "0000000000000000034", "aaaaaaaaaaaaaaaaaaaab", "aaaaaaaaaaaaaaaaaaaac", "aaaaaaaaaaaaaaaaaaaa", "bbbbbbbbbbbbbbbbbbbb"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    want = {(a, b) for a in names for b in names if a < b and 200 * lcs(a, b) / (len(a) + len(b)) >= 88}
    got = {(x.a, x.b) for x in cluster.similar_pairs(df, "name", F.lit("x")).collect()}
    assert ("0000000000000000012", "0000000000000000034") in want
    assert got == want


def test_drop_close_is_greedy(spark):
    r = random.Random(3)
    rows = [(r.choice("ab"), i, r.choice([0.0, None, *[float(x) for x in range(10, 200, 7)]])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, seq long, v double")
    got = {x.seq for x in dedup.drop_close(df, ["k"], "v", "seq", 0.9).collect()}
    want, kept = set(), {"a": [], "b": []}
    for k, i, v in rows:
        if v and any(min(v, x) / max(v, x) >= 0.9 for x in kept[k]):
            continue
        want.add(i)
        if v:
            kept[k].append(v)
    assert got == want


def test_drop_close_streams_a_long_run(spark):
    """A key whose values have no gaps is never a group or a window of one task."""
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), i, r.choice([None, 0.0, -2.0, r.lognormvariate(3, 2)])) for i in range(3000)] + [("c", i, 1.0 + i / 9000) for i in range(3000, 9000)]
    df = spark.createDataFrame(rows, "k string, seq long, v double")
    out = dedup.drop_close(df, ["k"], "v", "seq", 0.75)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "Window" not in plan
    want, kept = set(), {}
    for k, i, v in rows:
        near = kept.setdefault(k, [])
        if v and v > 0 and any(min(v, x) / max(v, x) >= 0.75 for x in near):
            continue
        want.add(i)
        if v and v > 0:
            near.append(v)
    assert {x.seq for x in out.collect()} == want
    assert out.columns == df.columns


def test_keep_best_and_first_then_latest(spark):
    df = spark.createDataFrame([(1, "a", None, 5), (1, "b", "x", 6), (1, "c", "y", 7), (2, None, None, 8)], "k int, a string, b string, seq int")
    assert sorted(x.seq for x in dedup.keep_richest(df, ["k"], ["a", "b"], F.col("seq")).collect()) == [6, 8]


def test_trailing_median(spark):
    v = [None, 4.0, 0.0, 10.0, 6.0, 2.0, 8.0]
    df = spark.createDataFrame(list(enumerate(v)), "t int, v double").withColumn("k", F.lit(1))
    got = [x.trailing_median for x in order.trailing_median(df, ["k"], "t", "v").orderBy("t").collect()]
    assert got == [None, None, 4.0, 4.0, 7.0, 6.0, 6.0]


def test_outliers_and_units(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 3.0, 4.0, 4000.0, None)] + [("b", 1.0), ("b", 9999.0)], "k string, v double")
    got = sorted((x.k, -1.0 if x.v is None else x.v) for x in reconcile.clear_outliers(df, ["k"], "v").collect())
    assert got == [("a", -1.0), ("a", -1.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 1.0), ("b", 9999.0)]
    f = spark.createDataFrame([(x,) for x in (9e5, 2e6, 5e9, 1e30)], "m double").select(reconcile.unit_factor(F.col("m")).alias("f")).collect()
    assert [x.f for x in f] == pytest.approx([1, 1e-3, 1e-6, 1e-12])


def test_differences_add_up(spark, sf):
    from holdwright.plans import changes

    d = changes.changes(changes.company_values(spark, sf))
    s = d.groupBy("ticker", "period").agg(F.sum("delta").alias("net"), F.sum(F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("both"))
    assert s.filter("net <> both").count() == 0
    assert d.filter("status = 'Added' and before is not null").count() == 0


def test_rollups_and_nearness(spark):
    df = spark.createDataFrame([("t", x) for x in ("A", "A - B", "A - B - C", "AB", "D - E")], "k string, name string")
    assert sorted(x.name for x in joins.drop_rollups(df, ["k"], "name").collect()) == ["A - B - C", "AB", "D - E"]
    a = spark.createDataFrame([(1, "x", "2024-01-10"), (2, "x", "2024-03-01")], "id int, k string, d string").withColumn("d", F.to_date("d"))
    b = spark.createDataFrame([(7, "x", "2024-01-03"), (8, "x", "2024-01-12"), (9, "y", "2024-01-10")], "f int, k string, e string").withColumn("e", F.to_date("e"))
    got = joins.nearest_within(a, b, ["k"], "id", "d", "e", 7, F.col("f")).collect()
    assert [(x.id, x.f, x.gap) for x in got] == [(1, 8, -2)]


def test_percentiles_and_shares(spark, sf):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 5.0)], "id string, v double").withColumn("k", F.lit(1))
    got = {x.id: x.score for x in rank.percentile_score(df, ["k"], F.col("v")).collect()}
    assert got == {"a": 0.0, "b": 33.0, "c": 33.0, "d": 100.0}
    one = rank.percentile_score(df.limit(1), ["k"], F.col("v")).first()
    assert one.score == 50.0
    from holdwright.plans import queries

    for name in ("type_mix", "rate_mix"):
        q = queries()[name](spark, sf)
        keys = [c for c in ("ticker", "period") if c in q.columns]
        assert all(math.isclose(x.s, 100, abs_tol=0.01) for x in q.groupBy(*keys).agg(F.sum("pct").alias("s")).collect())


def test_zero_fill_and_mode(spark):
    df = spark.createDataFrame([("a", "x", 2)], "k string, b string, n long")
    got = sorted((x.b, x.n) for x in aggregate.zero_filled(df, ["k"], "b", ["x", "y"], ["n"]).collect())
    assert got == [("x", 2), ("y", 0)]
    e = spark.createDataFrame([("a", "p", 3), ("a", "q", 1), ("a", "q", 5), ("a", "p", 4), ("a", None, 0)], "k string, v string, s int")
    m = aggregate.mode_first(e, ["k"], "v", F.col("s")).collect()
    assert [(x["mode"], x["count"]) for x in m] == [("q", 2)]
