"""Byte-level BPE encoding by overlapping chunks, and decoding.

Texts of more than one chunk are cut into chunks of ``CHUNK`` characters that
run ``OVERLAP`` characters into the next one, and the chunks are dealt to all
tasks.

1. Every chunk is split into pre-tokens on its own. The split pattern never
   looks back, so from any place where two splits share a boundary on they
   agree. A boundary near a chunk's end is trusted only ``LOOKAHEAD``
   characters before it, and only behind a character that is no white space
   (the pattern looks ahead of white space).
2. Stitching: chunk i ends and chunk i+1 begins at the first boundary in their
   overlap that both found. The pieces between these places are encoded in
   parallel, each exactly as inside the whole text.
3. A text in which some overlap shows no shared boundary (a run of letters or
   blanks longer than the overlap) is put together again from its chunks and
   encoded as one piece; very long runs of white space, on which the library's
   pattern engine overflows, are cut out of it and encoded on their own.

Texts that fit into one chunk need no stitching and are encoded where they
are read. Decoding concatenates the tokens' raw bytes.

Defined results: null text is encoded as the empty text, which has no ids.
Lone surrogates cannot occur in Spark strings. Repeated rows and null ids are
encoded like any other row; extra columns pass through, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from indicata.llm.common import shuffle_partitions, stage, text_or_empty

CHUNK = 16_384
OVERLAP = 512
LOOKAHEAD = 3
#: Texts that a Python worker encodes or decodes at a time.
SLICE = 128
#: White space as the pattern knows it. Runs of so many are cut out before the
#: library's pattern engine, whose stack grows with them, sees a text.
LONG_BLANKS = regex.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}+")
#: How a pattern must end for that: a run before a non-blank leaves its last character to what follows.
BLANK_RULE = "|\\s+(?!\\S)|\\s+"


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file; loaded once in each Python worker."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encode_whole(enc: tiktoken.Encoding, pattern: str, text: str) -> list[int]:
    """Ids of a text of any content. A long run of white space is one pre-token, but for its last character if more follows."""
    runs = list(LONG_BLANKS.finditer(text))
    if not runs:
        return enc.encode_ordinary(text)
    if not pattern.endswith(BLANK_RULE) or "\\s" in pattern[: -len(BLANK_RULE)].replace("[^\\s", ""):
        return [i for m in splitter(pattern).finditer(text) for i in enc._encode_single_piece(m.group())]
    ids, at = [], 0
    for m in runs:
        stop = m.end() - (m.end() < len(text))
        ids += enc.encode_ordinary(text[at : m.start()])
        ids += enc._encode_single_piece(text[m.start() : stop])
        at = stop
    return ids + enc.encode_ordinary(text[at:])


def cut(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Overlapping chunks; a text of up to one chunk and overlap is one chunk."""
    if len(text) <= chunk + overlap:
        return [text]
    return [text[i : i + chunk + overlap] for i in range(0, len(text) - overlap, chunk)]


def settled(c: str) -> bool:
    """A character old enough that every Unicode version in use puts it in the same class."""
    return unicodedata.ucd_3_2_0.category(c) != "Cn"


def boundaries(text: str, pattern: str, low: int, high: int, last: bool) -> list[int]:
    """Trusted pre-token boundaries of one chunk between ``low`` and ``high``."""
    trust = len(text) if last else len(text) - LOOKAHEAD
    out = []
    for m in splitter(pattern).finditer(text):
        e = m.start()
        if e > min(high, trust):
            break
        if e >= low and e > 0 and not text[e - 1].isspace() and settled(text[e - 1]) and settled(text[e]):
            out.append(e)
    return out


def stitches(chunks: list[str], pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int | None]:
    """Start of each chunk's piece inside the chunk (the first is 0); None where the overlap shows no shared boundary."""
    out: list[int | None] = [0]
    for i in range(1, len(chunks)):
        tail = {e - chunk for e in boundaries(chunks[i - 1], pattern, chunk, chunk + overlap, False)}
        head = boundaries(chunks[i], pattern, 0, overlap, i == len(chunks) - 1)
        out.append(next((e for e in head if e in tail), None))
    return out


def ids_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _in_slices(batches: Iterator[pa.RecordBatch], name: str, work: Callable[[list], list], new: str) -> Iterator[pa.RecordBatch]:
    """Replace column ``name`` by ``work`` of it, called ``new``, a few rows at a time, so that a worker holds little besides its input."""
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            part = b.slice(k, SLICE)
            rest = [n for n in part.schema.names if n != name]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in rest), pa.array(work(part.column(name).to_pylist()), pa.binary())], [*rest, new])


def _with_binary(df: DataFrame, drop: str, new: str) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != drop), T.StructField(new, T.BinaryType())])


def encode_pieces(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with the column ``text``, each encoded as one piece, replaced by ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        return _in_slices(batches, "text", lambda texts: [ids_bytes(encode_whole(enc, pattern, t)) for t in texts], "ids")

    return df.mapInArrow(run, _with_binary(df, "text", "ids"))


def decode(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with the column ``ids`` (little-endian unsigned 32-bit) replaced by ``decoded``, the tokens' raw bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        return _in_slices(batches, "ids", lambda ids: [enc.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in ids], "decoded")

    return df.mapInArrow(run, _with_binary(df, "ids", "decoded"))


def _chunk_rows(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, no, last, part, row): the chunks of long texts; ``row`` (the other columns) only on chunk 0."""
    row_type = long.schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                parts = cut(b.column("text")[r].as_py(), chunk, overlap)
                n = len(parts)
                row = b.column("row").slice(r, 1)
                rows = pa.concat_arrays([row, pa.nulls(n - 1, row.type)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("key")[r].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([i == n - 1 for i in range(n)]), pa.array(parts, pa.string()), rows],
                    ["key", "no", "last", "part", "row"],
                )

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("no", T.IntegerType()), T.StructField("last", T.BooleanType()), T.StructField("part", T.StringType()), T.StructField("row", row_type)])
    chunks = long.mapInArrow(run, schema)
    return chunks.repartition(shuffle_partitions(long.sparkSession), "key", "no")


def _edges(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, no, head, tail): trusted boundaries of each chunk in its first overlap and in the one with the next chunk (in that chunk's places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for part, no, last in zip(b.column("part"), b.column("no"), b.column("last")):
                text, end = part.as_py(), last.as_py()
                found = boundaries(text, pattern, 0, len(text), end)
                heads.append([e for e in found if e <= overlap] if no.as_py() else [])
                tails.append([] if end else [e - chunk for e in found if e >= chunk])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("no"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["key", "no", "head", "tail"])

    return chunks.select("key", "no", "last", "part").mapInArrow(run, "key long, no int, head array<int>, tail array<int>")


def encode_long(long: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, ids) for (key, text, row) of texts that need several chunks."""
    chunks = stage(_chunk_rows(long, chunk, overlap), "bpe-chunks")
    edges = _edges(chunks, pattern, chunk, overlap)
    by_text = Window.partitionBy("key").orderBy("no")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(by_text)))
    starts = edges.select("key", "no", F.when(F.col("no") == 0, 0).otherwise(shared).alias("start"))
    starts = starts.withColumn("stop", F.lead("start").over(by_text) + chunk).withColumn("lost", F.max(F.col("start").isNull()).over(Window.partitionBy("key")))
    starts = stage(starts, "bpe-stitches")

    whole = chunks.join(starts, ["key", "no"])
    piece = F.when(F.col("stop").isNull(), F.expr("substring(part, start + 1)")).otherwise(F.expr("substring(part, start + 1, greatest(stop - start, 0))"))
    pieces = whole.filter("NOT lost").select("key", "no", "row", piece.alias("text"))
    # Texts without a shared boundary somewhere: put together again, encoded as one piece.
    core = F.when(F.col("last"), F.col("part")).otherwise(F.substring("part", 1, chunk))
    again = (
        whole.filter("lost")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("no", core.alias("core")))).alias("cores"), F.first("row", ignorenulls=True).alias("row"))
        .select("key", F.lit(0).alias("no"), "row", F.array_join(F.col("cores.core"), "").alias("text"))
    )
    joined = encode_pieces(pieces.unionByName(again), ranks_path, pattern).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("no", F.hex("ids").alias("ids")))).alias("parts"), F.first("row", ignorenulls=True).alias("row")
    )
    return joined.select("row", F.unhex(F.array_join(F.col("parts.ids"), "")).alias("ids"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, ids): every row of ``docs`` as a struct, and its ids as little-endian unsigned 32-bit integers.

    ``docs`` must be a repeatable read (a table), as its rows are numbered.
    """
    rest = [c for c in docs.columns if c != text_col]
    fits = F.length("text") <= chunk + overlap
    rows = docs.select(text_or_empty(F.col(f"`{text_col}`")).alias("text"), F.struct(F.col(f"`{text_col}`").isNull().alias("none"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("rest")).alias("row"))
    short = encode_pieces(rows.filter(fits).select("row", "text"), ranks_path, pattern)
    long = rows.filter(~fits).withColumn("key", F.monotonically_increasing_id())
    both = short.unionByName(encode_long(long.select("key", "text", "row"), ranks_path, pattern, chunk, overlap))
    return both.select(F.struct(*[F.col("row.rest").getField(c).alias(c) for c in rest]).alias("row"), "ids")


def digests(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every encoded row; the ids are decoded for the last."""
    known = encoded.select(
        F.col("row").getField(id_col).alias(id_col),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    return decode(known, ranks_path, pattern).select(id_col, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def encode_text(text: str, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """One text by the same steps (for tests and small uses)."""
    enc = encoding(ranks_path, pattern)
    chunks = cut(text, chunk, overlap)
    starts = stitches(chunks, pattern, chunk, overlap)
    if None in starts:
        return encode_whole(enc, pattern, text)
    stops = [s + chunk for s in starts[1:]] + [len(chunks[-1])]
    return [i for c, a, b in zip(chunks, starts, stops) for i in enc.encode_ordinary(c[a:b])]

