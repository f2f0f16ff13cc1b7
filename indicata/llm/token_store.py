"""Token ids in patched frame-of-reference blocks.

A store is a folder of binary files. Each file holds segments; a segment is
self-contained (all numbers little-endian):

    magic "PFR1" | u64 bytes of the segment | u32 part | u32 number in part
    u64 documents | u64 ids | u32 block size | u32 blocks | u64 ids of the part before it
    documents x (i64 id, u8 id is null, u32 ids)
    (blocks + 1) x u64 block starts, from the first block on
    blocks: u32 minimum | u8 width | u16 exceptions | ids packed at that width
            | exceptions x u16 place | exceptions x u32 value

The width of a block is the smallest at which ``PERCENTILE`` percent of its
ids less the block minimum fit; the others are exceptions, stored whole. The
block starts allow any block to be read alone (``read_blocks``). Segments are
written in ascending order of document id by range-partitioned tasks, through
Spark's own file writer, so the store can lie on any file system Spark
reaches, and a lost task is written again.

Defined results: null text is empty and holds only the end id. Null ids sort
first. Repeated ids keep all their rows, in the order of their texts' XXH64,
then of the texts. A vocabulary with another normaliser or split than the one
that pieces are known to be exact for has whole texts encoded. An empty table gives an empty store.
Extra columns are not stored.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from indicata.llm.common import shuffle_partitions, stage, text_or_empty

BLOCK = 512
PERCENTILE = 90
#: Ids at which a segment is closed; a single longer document has one of its own.
SEGMENT_IDS = 1 << 19
SEGMENTS_PER_FILE = 32
END_ID = 1
#: White-space separated pieces whose ids a Python worker remembers at most.
CACHE_PIECES = 1_000_000
#: ASCII marks: neither letters, digits nor white space.
MARKS = string.punctuation

HEAD = struct.Struct("<4sQIIQQIIQ")
BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("patches", "<u2")])
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])


# --- blocks --------------------------------------------------------------------


def pack_rows(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned numbers below 2**width as rows of bytes."""
    if not width:
        return np.zeros((len(values), 0), np.uint8)
    whole = np.ascontiguousarray(values, "<u2" if width <= 16 else "<u4")
    bits = np.unpackbits(whole.view(np.uint8).ravel(), bitorder="little").reshape(whole.size, -1)[:, :width]
    if values.shape[1] * width % 8 == 0:  # rows end at a byte: one flat run is much faster
        return np.packbits(bits.ravel(), bitorder="little").reshape(len(values), -1)
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def unpack_rows(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros((len(packed), n), np.uint32)
    bits = np.unpackbits(packed, axis=1, count=n * width, bitorder="little").reshape(-1, width)
    filled = np.zeros((len(bits), 16 if width <= 16 else 32), np.uint8)
    filled[:, :width] = bits
    return np.packbits(filled.ravel(), bitorder="little").view("<u2" if width <= 16 else "<u4").astype(np.uint32).reshape(len(packed), n)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """(block starts, blocks) of unsigned 32-bit ids; the last block is filled up with its minimum."""
    n = -(-len(ids) // block)
    if not n:
        return np.zeros(1, np.uint64), b""
    values = np.empty(n * block, np.uint32)
    values[: len(ids)] = ids
    values[len(ids) :] = values[(n - 1) * block : len(ids)].min()
    values = values.reshape(n, block)
    low = values.min(axis=1)
    rest = values - low[:, None]
    need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bits of each number
    rank = -(-block * percentile // 100) - 1
    width = np.partition(need, rank, axis=1)[:, rank]
    patched = need > width[:, None]
    out: list[bytes] = [b""] * n
    heads = np.empty(n, BLOCK_HEAD)
    heads["low"], heads["width"], heads["patches"] = low, width, patched.sum(axis=1)
    raw = heads.tobytes()
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        for k in range(0, len(own), 1024):
            part = own[k : k + 1024]
            packed = pack_rows(np.where(patched[part], 0, rest[part]), int(w))
            for i, body in zip(part.tolist(), packed):
                places = np.flatnonzero(patched[i])
                out[i] = raw[i * 7 : i * 7 + 7] + body.tobytes() + places.astype("<u2").tobytes() + values[i, places].astype("<u4").tobytes()
    return np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.uint64), b"".join(out)


def read_blocks(starts: np.ndarray, data: bytes, first: int, last: int, block: int = BLOCK) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` - 1."""
    buffer = np.frombuffer(data, np.uint8)
    offsets = starts[first:last].astype(np.int64)
    heads = buffer[offsets[:, None] + np.arange(7)].copy().view(BLOCK_HEAD).reshape(-1)
    out = np.empty((last - first, block), np.uint32)
    for w in np.unique(heads["width"]):
        size = -(-int(w) * block // 8)
        own = np.flatnonzero(heads["width"] == w)
        for k in range(0, len(own), 1024):
            part = own[k : k + 1024]
            packed = buffer[offsets[part][:, None] + 7 + np.arange(size)]
            out[part] = unpack_rows(packed, int(w), block) + heads["low"][part][:, None]
    for i in np.flatnonzero(heads["patches"]).tolist():
        n = int(heads["patches"][i])
        at = int(offsets[i]) + 7 + -(-int(heads["width"][i]) * block // 8)
        places = np.frombuffer(data, "<u2", n, at)
        out[i, places] = np.frombuffer(data, "<u4", n, at + 2 * n)
    return out.reshape(-1)


def write_segment(docs: list[tuple[int | None, np.ndarray]], part: int, number: int, before: int, block: int = BLOCK) -> bytes:
    table = np.array([(0 if i is None else i, i is None, len(x)) for i, x in docs], DOC)
    ids = np.concatenate([x for _, x in docs]) if docs else np.empty(0, np.uint32)
    starts, data = pack(ids, block)
    body = table.tobytes() + starts.astype("<u8").tobytes() + data
    return HEAD.pack(b"PFR1", HEAD.size + len(body), part, number, len(docs), len(ids), block, len(starts) - 1, before) + body


def read_segments(content: bytes) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(part, number, ids of the part before it, documents, ids) of each segment of a file."""
    at = 0
    while at < len(content):
        magic, size, part, number, n_docs, n_ids, block, blocks, before = HEAD.unpack_from(content, at)
        if magic != b"PFR1":
            raise ValueError("not a token store")
        docs = np.frombuffer(content, DOC, n_docs, at + HEAD.size)
        index = at + HEAD.size + DOC.itemsize * n_docs
        starts = np.frombuffer(content, "<u8", blocks + 1, index)
        ids = read_blocks(starts, content[index + 8 * (blocks + 1) : at + size], 0, blocks, block)[:n_ids]
        yield part, number, before, docs, ids
        at += size + 1  # the writer's line end


# --- ids ---------------------------------------------------------------------------


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def remembered(path: str) -> dict[str, bytes]:
    """Ids of known pieces; shared by the tasks that a Python worker runs."""
    return {"": b""}


@lru_cache(maxsize=1)
def byte_level() -> dict[int, str]:
    """Each letter of Latin-1 as the library's byte-level step writes it."""
    step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {ord(c): step.pre_tokenize_str(c)[0][0] for c in map(chr, range(128, 256)) if c.isalpha()}


#: The normaliser and split for which a text's ids are those of its pieces.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def encoder(path: str) -> Callable[[list[str]], Iterator[np.ndarray]]:
    """By pieces if the vocabulary file has the normaliser and split that allow it; else whole texts by the library."""
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)
    if [(steps.get(n) or {}).get(parts) for n, parts in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))] == [NORMALIZER, SPLIT]:
        return PieceEncoder(path)
    whole = tokenizer(path)
    return lambda texts: (np.array(e.ids, "<u4") for e in whole.encode_batch_fast(texts, add_special_tokens=False))


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, one call for each new piece.

    The vocabulary's normaliser and split drop white space and never join
    characters across it, so a text's ids are those of its pieces between
    blanks, tabs and line ends. Ids of known pieces are remembered. Texts that
    fit Latin-1, where the normaliser does no more than lower each letter, are
    lower-cased first, so that fewer pieces are new.

    The split also parts letters from ASCII marks after them, and leaves a run
    of letters whole. So a new piece of Latin-1 letters, with or without marks
    behind, goes to the library's model at once, without its normaliser and
    split; any other new piece takes the library's whole path.
    """

    def __init__(self, path: str, keep: int = CACHE_PIECES) -> None:
        self.tokenizer, self.keep, self.known = tokenizer(path), keep, remembered(path)
        self.model, self.letters = self.tokenizer.model, byte_level()

    def word(self, word: str) -> bytes:
        """Ids of a run of Latin-1 letters."""
        word = word.lower()
        return array("I", [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.letters))]).tobytes()

    def learn(self, new: list[str]) -> None:
        known, rest = self.known, []
        for p in new:
            word = p.rstrip(MARKS)
            marks = p[len(word) :]
            if not word.isalpha() or not (word.isascii() or max(word) <= "\xff"):
                rest.append(p)
                continue
            ids = (known.get(word) if marks else None) or self.word(word)
            if marks and marks not in known:
                known[marks] = self.whole([marks])[0]
            known[p] = ids + known[marks] if marks else ids
        known.update(zip(rest, self.whole(rest)))

    def whole(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    @staticmethod
    def pieces(text: str) -> list[str]:
        try:
            text.encode("latin-1")
            text = text.lower() if "<|" not in text else text
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        known = self.known
        for text in texts:
            pieces = self.pieces(text)
            found = list(map(known.get, pieces))
            if None in found:
                new = list({p for p, ids in zip(pieces, found) if ids is None})
                if len(known) + len(new) > self.keep:
                    known.clear()
                    new = list(set(pieces))
                self.learn(new)
                found = map(known.__getitem__, pieces)
            yield np.frombuffer(b"".join(found), "<u4")


# --- Spark -------------------------------------------------------------------------


def write_store(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text and write the store at ``path``."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    # Rows of one id, also very many, are dealt and ordered by their texts; equal ones anywhere among themselves.
    order = ["id", F.xxhash64("text")]
    ordered = rows.withColumn("spread", F.rand(0)).repartitionByRange(n, *order, "spread").sortWithinPartitions(*order, "text").drop("spread")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        number = before = held_ids = 0
        held: list[tuple[int | None, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal number, before, held, held_ids
            segment = write_segment(held, part, number, before)
            number, before, held, held_ids = number + 1, before + held_ids, [], 0
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.binary())], ["segment"])

        for b in batches:
            for k in range(0, b.num_rows, 64):
                some = b.slice(k, 64)
                for i, ids in zip(some.column("id").to_pylist(), encode(some.column("text").to_pylist())):
                    if held and held_ids + len(ids) + 1 > segment_ids:
                        yield close()
                    held.append((i, np.append(ids, np.uint32(end_id))))
                    held_ids += len(ids) + 1
        if held:
            yield close()

    segments = ordered.mapInArrow(run, "segment binary")
    segments.select(F.col("segment").cast("string")).write.option("lineSep", "\n").option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(id, part, number, place, start_in_part, n_tokens, ids_crc32, ids) of every stored document.

    ``ids`` are little-endian unsigned 32-bit integers; null unless ``with_ids``.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                for part, number, before, docs, ids in read_segments(content.as_py()):
                    n = len(docs)
                    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(docs["n"].astype(np.int64))
                    starts = ends - docs["n"]
                    each = [raw[4 * a : 4 * z] for a, z in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(docs["id"], mask=docs["null"].astype(bool)),
                            pa.array(np.full(n, part, np.int64)),
                            pa.array(np.full(n, number, np.int64)),
                            pa.array(np.arange(n, dtype=np.int64)),
                            pa.array(before + starts),
                            pa.array(docs["n"].astype(np.int64)),
                            pa.array([zlib.crc32(x) for x in each], pa.int64()),
                            pa.array(each, pa.binary()) if with_ids else pa.nulls(n, pa.binary()),
                        ],
                        ["id", "part", "number", "place", "start_in_part", "n_tokens", "ids_crc32", "ids"],
                    )

    return files.mapInArrow(run, "id long, part long, number long, place long, start_in_part long, n_tokens long, ids_crc32 long, ids binary")


def read_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    rows = stage(read_store(spark, path, with_ids=False).drop("ids"), "token-digests")
    # One row for each writing task, so this window is as small as their number.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "token-parts")
    return rows.join(parts, "part").select(F.col("id").alias(id_col), (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
