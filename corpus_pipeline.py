"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage works on all that its predecessor kept. The first four return the
columns of ``documents``; the last returns one row per remaining row with its
token digest. Null ids and texts, empty and very long texts, repeated rows and
extra columns are handled as the operators' docstrings define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import bpe, exact_dedup, mixing, simhash, toxicity
from indicata.llm.common import stage, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the labelled learning fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages brought to their target weights; every document stays, rare languages are repeated."""
    labelled = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))
    return mixing.resample(docs, F.col("lang"), labelled, least=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return bpe.digests(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: A trained classifier, fingerprints and a byte-pair encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
