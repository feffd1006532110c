"""The pipeline's stages, each against a brute-force version over what the stage before kept."""

import corpus_pipeline
from llm.test_decontaminate import brute as contaminated
from llm.test_simhash import brute as near

from holdwright.llm import langid, mixing, sharding


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    columns, now = docs.columns, docs
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in now.select("doc_id", "text").collect()]
        now = stage(spark, now, sf).cache()
        after = sorted(r.doc_id for r in now.select("doc_id").collect())
        if name != names[-1]:
            assert now.columns == columns
        if name == "language":
            model = langid.fit(docs, ~langid.held_out())
            far = {i: (c[0].max(), model.least[c[1]]) if (c := model.cosines(t)) else (0.0, 1.0) for i, t in before}
            gone = sorted(i for i, (cos, least) in far.items() if cos < max(1 - langid.MAX_DISTANCE, least))
            assert after == sorted(i for i, _ in before if i not in gone) and len(gone) <= 0.02 * len(before)
        elif name == "near_duplicates":
            assert after == sorted(i for i, _, c in near(before) if i == c) and len(after) < len(before)
        elif name == "decontamination":
            assert after == sorted(r[0] for r in contaminated(before, bench) if not r[-1]) and len(after) < len(before)
        elif name == "mixture":
            cut = spark.createDataFrame(before, "doc_id long, text string").join(docs.select("doc_id", "lang", "source"), "doc_id")
            want = sorted(r.doc_id for r in mixing.mix(cut).select("doc.doc_id").collect())
            assert after == want and set(after) <= {i for i, _ in before} and after != sorted(i for i, _ in before)
        else:
            table = sharding.fill_table()
            assert all(r.shard == sharding.SHARDS[table[r.slot]] for r in now.collect())
            assert after == sorted(i for i, _ in before)


def test_run_is_its_stages(spark, sf):
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "slot", "shard").collect()))
    found = rows(corpus_pipeline.run(spark, sf))
    assert found == rows(now) and len(found) > 50
