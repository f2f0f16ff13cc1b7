"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.sources.sinks import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a written table (a lost executor re-reads files) and
    gives Catalyst the real size, so small sides broadcast by
    ``autoBroadcastJoinThreshold`` and large ones do not.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    """The whole text; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_sql(keys: str, name: str) -> str:
    """SQL CTEs (in a ``WITH RECURSIVE``) ending in ``name`` (s, crc): the unsigned CRC-32 of every text ``s`` of the query ``keys``."""
    return f"""
{name}_bits AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM {name}_bits WHERE k < 8
), {name}_table AS (SELECT i, c AS entry FROM {name}_bits WHERE k = 8),
{name}_bytes AS (
  SELECT s, hex(encode(s)) AS h, 0 AS k, 4294967295::BIGINT AS c FROM (SELECT DISTINCT s FROM ({keys}))
  UNION ALL SELECT s, h, k + 1, xor(c >> 8, entry) FROM {name}_bytes JOIN {name}_table ON i = xor(c, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) & 255 WHERE 2 * k < length(h)
), {name} AS (SELECT s, xor(c, 4294967295::BIGINT) AS crc FROM {name}_bytes WHERE 2 * k = length(h))"""
