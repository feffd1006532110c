from collections import Counter

import pytest
from llm.odd import no_documents, odd_documents

from holdwright.llm.sharding import SHARDS, SLOTS, assign_shards, fill_table, write_shards


def test_table_is_even_and_moves_little():
    table = fill_table()
    per = Counter(table)
    assert len(table) == SLOTS and len(per) == len(SHARDS) and max(per.values()) - min(per.values()) <= 1
    fewer = fill_table(SHARDS[:-1])
    moved = sum(SHARDS[a] != SHARDS[b] for a, b in zip(table, fewer, strict=True)) / SLOTS
    assert 1 / 32 <= moved < 0.1
    with pytest.raises(ValueError):
        fill_table(())
    with pytest.raises(ValueError):
        fill_table(SHARDS, 4096)


def test_assign(spark, tmp_path):
    docs = odd_documents(spark)
    out = assign_shards(docs)
    assert out.count() == docs.count() and out.columns.count("shard") == 1
    assert out.filter("doc_id = 6").select("shard").distinct().count() == 1
    assert assign_shards(no_documents(spark)).count() == 0
    write_shards(docs, str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == docs.count()
