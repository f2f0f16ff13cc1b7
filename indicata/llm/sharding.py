"""Sharding by extendible hashing.

Every row gets a 60-bit code: 40 bits of its key's MD5, then 20 bits of its
number, so that a key shared by a third of all rows can still be split. The
directory is indexed by a prefix of the code. It starts as one bucket; a
bucket that holds more bytes than the limit is split on the next bit, and only
that one, until every bucket fits. The leaves are the shards.

The splits are decided on a histogram of code prefixes, not on the rows: one
aggregation gives the bytes under each prefix of ``FINE`` bits more than an
even spread would need, and sums over shorter prefixes tell which buckets are
oversized. Only prefixes that are still oversized at that depth are counted
again, ``STEP`` bits deeper. The rows move once, range-partitioned by code, so
tasks stay even whatever the number of shards, and each shard is a folder.

Defined results: null text has size 0; null keys are one key. A bucket with a
single row is never split, so a row larger than the limit is a shard of its
own (``oversized``). Rows that repeat the key are split by row number, so
``docs`` must be a repeatable read (a table). An empty table has no shards.
Extra columns are stored too; columns named ``shard``, ``depth``, ``bytes`` or
``code`` are kept inside the stored row and do not clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.llm.common import shuffle_partitions, stage

BITS = 60
KEY_BITS = 40
LIMIT = 32 << 20
FINE = 2
STEP = 8


def code_of(key: Column, number: Column) -> Column:
    """40 bits of the key's hash, then 20 bits of the row number's hash."""

    def hexed(c: Column, digits: int) -> Column:
        return F.conv(F.substring(F.md5(c.cast("binary")), 1, digits), 16, 10).cast("long")

    high = hexed(F.coalesce(key.cast("string"), F.lit("")), KEY_BITS // 4)
    return F.shiftleft(high, BITS - KEY_BITS) + hexed(number.cast("string"), (BITS - KEY_BITS) // 4)


def _prefix(code: Column, depth: int) -> Column:
    return F.shiftright(code, BITS - depth)


def _histogram(codes: DataFrame, depth: int) -> DataFrame:
    return codes.groupBy(_prefix(F.col("code"), depth).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))


def _leaves(histogram: DataFrame, top: int, bottom: int, limit: int) -> DataFrame:
    """(prefix, depth) for prefixes of ``bottom`` bits: depth of the leaf they belong to, ``bottom`` + 1 if still oversized."""
    levels = F.explode(F.sequence(F.lit(top), F.lit(bottom))).alias("level")
    up = lambda: F.call_function("shiftright", F.col("prefix"), (F.lit(bottom) - F.col("level")).cast("int"))
    spread = histogram.select("prefix", "bytes", "n", levels).withColumn("bucket", up())
    split = spread.groupBy("level", "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).filter((F.col("bytes") > limit) & (F.col("n") > 1)).select("level", "bucket", F.lit(1).alias("split"))
    ancestors = histogram.select("prefix", levels).withColumn("bucket", up()).join(split, ["level", "bucket"], "left")
    return ancestors.groupBy("prefix").agg((F.coalesce(F.sum("split"), F.lit(0)) + top).cast("int").alias("depth"))


def directory(codes: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """[(bits, (prefix, depth))]: the leaf depth under every prefix of so many bits; later entries refine earlier ones."""
    total = codes.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
    top, bottom = 0, min(BITS, math.ceil(math.log2(max(1, total / limit))) + FINE)
    out: list[tuple[int, DataFrame]] = []
    rest = codes
    while True:
        leaves = stage(_leaves(stage(_histogram(rest, bottom), "shard-histogram"), top, bottom, limit), "shard-leaves")
        out.append((bottom, leaves))
        open_ = leaves.filter(F.col("depth") > bottom).select(F.col("prefix").alias("open"))
        if bottom >= BITS or open_.isEmpty():
            return out
        rest = rest.join(open_, _prefix(F.col("code"), bottom) == F.col("open"), "left_semi")
        top, bottom = bottom + 1, min(BITS, bottom + STEP)


def assign(rows: DataFrame, found: list[tuple[int, DataFrame]]) -> DataFrame:
    """``rows`` (with ``code``) plus ``depth`` and ``shard``: "b" and the bits of the leaf."""
    depth: Column = F.lit(None).cast("int")
    names = []
    for i, (bits, leaves) in enumerate(found):
        side = leaves.select(F.col("prefix").alias(f"prefix_{i}"), F.col("depth").alias(f"depth_{i}"))
        rows = rows.join(side, _prefix(F.col("code"), bits) == F.col(f"prefix_{i}"), "left")
        depth = F.coalesce(F.col(f"depth_{i}"), depth)
        names += [f"prefix_{i}", f"depth_{i}"]
    rows = rows.withColumn("depth", F.least(depth, F.lit(BITS))).drop(*names)
    bits = F.lpad(F.conv(F.col("code").cast("string"), 10, 2), BITS, "0")
    return rows.withColumn("shard", F.concat(F.lit("b"), F.substring(bits, F.lit(1), F.col("depth"))))


def coded(docs: DataFrame, key_col: str, size: Column) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(code_of(F.col(f"`{key_col}`"), F.monotonically_increasing_id()).alias("code"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"), row)


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> None:
    """Write every row of ``docs`` to the folder of its shard under ``path``."""
    rows = coded(docs, key_col, F.octet_length(F.col(f"`{text_col}`")))
    placed = assign(rows, directory(rows.select("code", "bytes"), limit))
    spread = placed.repartitionByRange(shuffle_partitions(docs.sparkSession), "code").sortWithinPartitions("shard")
    spread.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """(code, bytes, row, depth, shard) of the stored rows; ``docs`` gives the schema."""
    row = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("row", row), T.StructField("depth", T.IntegerType()), T.StructField("shard", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def placements(spark: SparkSession, path: str, docs: DataFrame, id_col: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """One row per stored row: id, shard, depth, bytes, shard_bytes, shard_rows, oversized."""
    light = read_shards(spark, path, docs).select(F.col("row").getField(id_col).alias(id_col), "shard", "depth", "bytes")
    sizes = stage(light.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows")), "shard-sizes")
    return light.join(sizes, "shard").select(id_col, "shard", "depth", "bytes", "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("oversized"))


def oracle_sql(limit: int = LIMIT) -> str:
    """DuckDB SQL for ``placements`` of ``documents`` (ids are unique there, so the row-number bits never decide)."""
    return f"""
WITH coded AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {KEY_BITS // 4}))::BIGINT AS code FROM documents
), split AS (
  SELECT level, code >> ({KEY_BITS} - level) AS bucket FROM coded, (SELECT unnest(range(0, {KEY_BITS}))::INT AS level)
  GROUP BY 1, 2 HAVING sum(bytes) > {limit} AND count(*) > 1
), leaf AS (
  SELECT c.doc_id, c.code, c.bytes, count(s.level)::INT AS depth FROM coded c LEFT JOIN split s ON s.bucket = c.code >> ({KEY_BITS} - s.level)
  GROUP BY 1, 2, 3
), placed AS (
  SELECT doc_id, bytes, depth, 'b' || substr(lpad(bin(code), {KEY_BITS}, '0'), 1, depth) AS shard FROM leaf
)
SELECT doc_id, shard, depth, bytes, (sum(bytes) OVER (PARTITION BY shard))::BIGINT AS shard_bytes, count(*) OVER (PARTITION BY shard) AS shard_rows,
  sum(bytes) OVER (PARTITION BY shard) > {limit} AS oversized
FROM placed"""
