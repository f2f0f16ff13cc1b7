"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from indicata.llm import bpe, conversation_repair, exact_dedup, kdtree, mixing, quality_rules, secret_scan, sharding, simhash, spelling, token_store, toxicity, warc
from indicata.llm.common import table
from indicata.sources.sinks import fresh_path

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Byte limit of a shard of the registered query; the session setting ``spark.indicata.shard.bytes`` overrides it.
SHARD_BYTES = 1 << 20


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), fresh_path(spark, "shards")
    limit = int(spark.conf.get("spark.indicata.shard.bytes", str(SHARD_BYTES)))
    sharding.write_shards(docs, path, limit=limit)
    return sharding.placements(spark, path, docs, limit=limit)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.resolve_revisits(warc.assemble(warc.read_records(spark, path))).drop("ok")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.scorer(model)(F.col("text")).alias("score"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_store.write_store(table(spark, sf_dir, "documents"), path, WORD_VOCABULARY)
    return token_store.read_digests(spark, path)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS, public_tokenizers.PATTERN)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, F.col("lang"), trusted(spark, sf_dir)).drop("text_key")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return secret_scan.scan(table(spark, sf_dir, "documents"), labelled)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.decisions(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(table(spark, sf_dir, "conversations"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the labelled documents of good quality; they teach the mixing classifier."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_token_store": op5_token_store,
    "op6_top_k": op6_top_k,
    "op7_bpe": op7_bpe,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_sharding": sharding.oracle_sql(SHARD_BYTES),
    "op2_warc": f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), r AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM r""",
    "op6_top_k": kdtree.oracle_sql(),
    "op8_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, text_sha256
FROM d""",
    "op11_quality_rules": quality_rules.oracle_sql(),
    "op12_spelling": spelling.oracle_sql(),
    "op13_conversations": conversation_repair.oracle_sql(),
}
