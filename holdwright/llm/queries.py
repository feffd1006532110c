"""Queries opN_<name> over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, chat, decontaminate, embed_dedup, langid, lm_score, mixing, oracles, search, secrets, sharding, simhash, warc, wavelet


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_read(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(_read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs, ~langid.held_out())
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    chosen = mixing.mix(docs)
    return chosen.select("doc.doc_id", "epoch", "tokens", *mixing.LEVELS)


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(_read(spark, sf_dir, "documents"), _tokenizer())


def _tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(_read(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")
    return out.select("conv_id", "perspective", "part", "n_turns", "start", "text", spans.alias("mask"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(_read(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 3))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
