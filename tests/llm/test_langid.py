import base64
import random
import zlib

import numpy as np
from llm.odd import no_documents, odd_documents
from pyspark.sql import functions as F

from holdwright.llm import langid, queries


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = queries.op4_language(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == truth[r.doc_id] for r in tested])
    assert right > 0.97, right
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_model_against_all_centroids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    for r in docs.limit(20).collect():
        at, n = langid.ngrams(r.text)
        dense = np.zeros(langid.DIM)
        dense[at] = np.log1p(n) * model.idf[at]
        cos = model.centroids @ dense / np.linalg.norm(dense)
        assert model.predict(r.text) == (model.langs[int(cos.argmax())], float(np.clip(cos.max(), 0, 1))) or abs(cos.max() - model.predict(r.text)[1]) < 1e-6


def test_frequencies_against_all_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs, ~langid.held_out())
    taught = [r.text for r in docs.collect() if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5]
    df = np.zeros(langid.DIM)
    for text in taught:
        df[langid.ngrams(text)[0]] += 1
    assert np.allclose(model.idf, np.log((1 + len(taught)) / (1 + df)) + 1e-3)
    assert sorted(set(model.langs)) == sorted({r.lang for r in docs.collect() if r.lang is not None})


def test_one_id_for_all_rows_is_sampled(spark):
    same = spark.range(3000, numPartitions=4).select(F.lit(7).alias("doc_id"), F.concat(F.lit("text number "), F.format_string("%x", F.xxhash64("id"))).alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(same, sample=50)
    assert set(model.langs) == {"en"} and len(model.langs) == langid.CENTROIDS


def test_a_language_of_one_repeated_row_is_learned(spark):
    one = spark.range(20_000, numPartitions=4).select(F.lit(7).alias("doc_id"), F.lit("the same line of text again").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(5000, numPartitions=4).select(F.col("id").alias("doc_id"), F.format_string("zwölf böse füchse %x", F.xxhash64("id")).alias("text"), F.lit("de").alias("lang"))
    model = langid.fit(one.unionByName(other), sample=50)
    assert set(model.langs) == {"en", "de"} and model.langs.count("en") == 1
    assert model.predict("the same line")[0] == "en" and model.predict("böse füchse")[0] == "de"
    assert langid.fit(one).langs == ["en"]


def test_sample_and_centroids_against_plain_loops(spark, sf):
    """The sampled texts by their places, then the furthest-first choice and rounds of means, row by row."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs, sample=20)
    rows = docs.filter("lang is not null and text is not null").select("lang", F.col("doc_id").cast("string").alias("id"), "text", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)).alias("place")).distinct().collect()
    for lang in sorted({r.lang for r in rows}):
        mine = [r for r in rows if r.lang == lang]
        below = max(20 * (1 << 30) / len({r.place for r in mine}), min(r.place for r in mine) + 1)
        x = []
        for r in sorted((r for r in mine if r.place < below), key=lambda r: (r.id, r.text)):
            at, n = langid.ngrams(r.text)
            v = np.zeros(langid.DIM, np.float32)
            v[at] = np.log1p(n) * model.idf[at]
            x.append(v / np.linalg.norm(v))
        chosen = [0]
        while len(chosen) < langid.CENTROIDS and min(max(float(v @ x[c]) for c in chosen) for v in x) < 1 - 1e-6:
            chosen.append(int(np.argmin([max(float(v @ x[c]) for c in chosen) for v in x])))
        c = [x[k] for k in chosen]
        for _ in range(12):
            of = [int(np.argmax([float(v @ w) for w in c])) for v in x]
            sums = [sum(v for v, o in zip(x, of, strict=True) if o == k) if k in of else c[k] for k in range(len(c))]
            c = [s / np.linalg.norm(s) for s in sums]
        got = model.centroids[[k for k, m in enumerate(model.langs) if m == lang]]
        assert np.allclose(got, np.array(c), atol=1e-4)


def test_learned_rejection_against_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    seen = []
    for r in docs.filter("lang is not null and text is not null").collect():
        found = model.cosines(r.text)
        if found is not None:
            own = max(c for c, m in zip(found[0], model.langs, strict=True) if m == r.lang)
            seen.append((found[1], int(min(max(own, 0.0), 1.0) * langid.STEPS)))
    for size in range(langid.CLASSES):
        for d in range(langid.CLASSES):
            near = sorted(s for k, s in seen if abs(k - size) <= d)
            if len(near) >= min(langid.ENOUGH, len(seen)):
                assert abs(model.least[size] - langid.SLACK * near[int(langid.QUANTILE * len(near))] / langid.STEPS) < 1e-9
                break


def test_odd(spark, sf):
    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    odd = odd_documents(spark)
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and all(got[k].rejected and got[k].score == 0 for k in (1, 2, 3, 8))
    assert got[4].lang_pred in model.langs and got[9].lang_pred in model.langs
    assert langid.predict(odd, langid.fit(no_documents(spark))).filter("lang_pred <> 'und'").count() == 0
    kept = langid.keep_known(odd)
    assert kept.columns == odd.columns and {1, 2, 3, 8}.isdisjoint({r.doc_id for r in kept.collect()})


def test_junk_of_any_length_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~langid.held_out())
    r = random.Random(5)
    script = lambda lo, hi, n: " ".join("".join(chr(r.randint(lo, hi)) for _ in range(r.randint(2, 9))) for _ in range(n))
    junk = {}
    for n in (20, 100, 500, 2000, 10_000):
        junk["base64", n] = " ".join(base64.b64encode(r.randbytes(r.randint(4, 9))).decode() for _ in range(n))
        junk["letters", n] = script(0x61, 0x7A, n)
        junk["cyrillic", n] = script(0x430, 0x44F, n)
        junk["cjk", n] = script(0x4E00, 0x9FFF, n)
    assert [k for k, t in junk.items() if not model.judge(t)[2]] == []
    rows = langid.predict(docs.filter(langid.held_out() & (~F.col("lang").isNull())), model).collect()
    assert sum(x.rejected for x in rows) <= 0.01 * len(rows)
    known = langid.keep_known(docs.unionByName(docs.limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit(junk["cjk", 2000]).alias("text"), F.lit(None).cast("string").alias("lang")), allowMissingColumns=True))
    assert known.filter("doc_id = -1").count() == 0
