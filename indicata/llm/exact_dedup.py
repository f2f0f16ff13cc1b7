"""Exact duplicate removal with two passes over a Bloom filter (DataFrame functions only).

Pass one hashes every text to ``PROBES`` bits of one 32,768-bit filter block
and counts the bits; bits that two or more rows set make the filter of
repeated hashes. Pass two tests every row against that filter. A row with an
unset bit is certainly unique and passes straight through; only the others
are shuffled and grouped by the text's SHA-256. The filter's false positives
cost a few shuffled rows, never a wrong answer.

Size of the broadcast filter: ``BITS_PER_ROW`` bits for each row, rounded up
to whole blocks, and at most ``MAX_FILTER_BYTES``. Beyond that bound the
filter only gets denser, so more rows take the shuffled path; results are the
same.

Defined results: null text equals the empty text. Of equal texts the row with
the largest id stays (a null id counts as smaller than any id). Rows that
repeat both id and text form one group: as decisions they all carry
``kept = true`` when their id is the kept one, as a filter exactly one of
them stays. An empty table gives an empty result. Extra columns, whatever
their names, pass through ``drop_copies`` and are not used by ``decisions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicata.llm.common import stage, text_or_empty

BLOCK_BITS = 32_768
PROBES = 3
BITS_PER_ROW = 16
MAX_FILTER_BYTES = 256 << 20


def _digest(text_col: str) -> Column:
    return F.sha2(text_or_empty(text_col).cast("binary"), 256)


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks))


def _bits(digest: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(1, PROBES + 1)]


def repeat_filter(digests: DataFrame, blocks: int) -> DataFrame:
    """Filter of bits set by two or more rows: one (block, 4 KB bitmap) row per block.

    The count is pre-aggregated on the map side, so a hash that a third of
    the rows share arrives as one row per task.
    """
    d = F.col("digest")
    bits = digests.select(_block(d, blocks).alias("block"), F.explode(F.array_distinct(F.array(*_bits(d)))).alias("bit"))
    twice = bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap"))


def _set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def flag_possible_repeats(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """``rows`` (with a ``digest`` column) plus ``repeated``: false only if no other row has the digest."""
    n = digests.count()
    blocks = max(1, min(-(-n * BITS_PER_ROW // BLOCK_BITS), MAX_FILTER_BYTES * 8 // BLOCK_BITS))
    seen = stage(repeat_filter(digests, blocks), "dedup-filter")
    d = F.col("digest")
    tested = rows.withColumn("block", _block(d, blocks)).join(
        F.broadcast(seen), "block", "left"  # at most MAX_FILTER_BYTES
    )
    hit = F.lit(True)
    for bit in _bits(d):
        hit = hit & _set(F.col("bitmap"), bit)
    return tested.withColumn("repeated", F.coalesce(hit, F.lit(False))).drop("block", "bitmap")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    light = stage(docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest")), "dedup-digests")
    flagged = stage(flag_possible_repeats(light, light), "dedup-flagged")
    once = flagged.filter("NOT repeated").select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    again = flagged.filter("repeated").select("id", "digest")
    # Written, so that the join below reads two plain shuffles and a hot
    # group of copies can be split between tasks.
    groups = stage(again.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    out = once.unionByName(again.join(groups, "digest").select("id", "digest", "keep_id", "group_size"))
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without copies, all columns: unique rows never shuffle."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _digest(text_col).alias("digest"))
    flagged = flag_possible_repeats(rows, rows.select("digest"))
    once = flagged.filter("NOT repeated").select("row")
    # The rank limit is applied before the shuffle as well, so a hot group
    # of copies sends one row per task.
    best = Window.partitionBy("digest").orderBy(F.col("row").getField(id_col).desc_nulls_last())
    again = flagged.filter("repeated").withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("row")
    return once.unionByName(again).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
