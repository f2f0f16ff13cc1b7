"""Token store: exact round trips of blocks, segments and whole tables."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from indicata.llm import queries, token_store as ts

TOKENIZER = Tokenizer.from_file(queries.WORD_VOCABULARY)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=400), st.sampled_from([1, 7, 16, 512]), st.sampled_from([50, 90, 100]))
@settings(max_examples=200, deadline=None)
def test_blocks_round_trip(ids, block, percentile):
    values = np.array(ids, np.uint32)
    starts, data = ts.pack(values, block, percentile)
    blocks = len(starts) - 1
    assert (ts.read_blocks(starts, data, 0, blocks, block)[: len(ids)] == values).all()
    if blocks > 1:  # the index gives any block alone
        assert (ts.read_blocks(starts, data, 1, 2, block)[: max(0, len(ids) - block)][:block] == values[block : 2 * block]).all()


def test_outliers_are_patched_and_do_not_widen_the_block():
    values = np.arange(512, dtype=np.uint32) % 8 + 1000
    even = len(ts.pack(values)[1])
    values[[3, 500]] = 4_000_000_000
    starts, data = ts.pack(values)
    assert len(data) == even + 2 * 6
    assert (ts.read_blocks(starts, data, 0, 1) == values).all()


def test_segments_round_trip():
    docs = [(None, np.array([1], np.uint32)), (-5, np.arange(1000, dtype=np.uint32)), (-5, np.array([], np.uint32)), (2**40, np.array([49_407, 1], np.uint32))]
    content = ts.write_segment(docs, 3, 4, 99) + b"\n" + ts.write_segment(docs[:1], 3, 5, 101) + b"\n"
    (part, number, before, table, ids), second = ts.read_segments(content)
    assert (part, number, before) == (3, 4, 99) and second[1] == 5
    assert [(None if n else int(i)) for i, n in zip(table["id"], table["null"])] == [i for i, _ in docs]
    assert (ids == np.concatenate([x for _, x in docs])).all()


@given(st.lists(st.sampled_from(list("aB1 \n\t\r'.!é") + ["\xa0", "\x1c", "́", "'s", "中", " ", "<|endoftext|>", "ǅ", "İ"]), max_size=60).map("".join))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert list(next(ts.PieceEncoder(queries.WORD_VOCABULARY)([text]))) == plain_ids(text)[:-1]


@given(st.lists(st.tuples(st.text(st.characters(max_codepoint=0x17F, exclude_characters=" "), max_size=6), st.text(st.sampled_from("=|<>,.'\"#-_"), max_size=3), st.sampled_from(["", " ", " ̸", "̸ "])).map("".join), max_size=12).map("".join))
@settings(max_examples=500, deadline=None)
def test_letters_with_marks_behind_give_the_ids_of_the_whole_text(text):
    assert list(next(ts.PieceEncoder(queries.WORD_VOCABULARY)([text]))) == plain_ids(text)[:-1]


def test_every_latin_1_character_alone_and_beside_letters():
    text = " ".join(f"{c} a{c} {c}b. {c}{c}," for c in map(chr, range(256)))
    assert list(next(ts.PieceEncoder(queries.WORD_VOCABULARY)([text]))) == plain_ids(text)[:-1]
    assert list(next(ts.PieceEncoder(queries.WORD_VOCABULARY)([text + " 中"]))) == plain_ids(text + " 中")[:-1]


def test_a_small_memory_of_pieces_changes_nothing():
    texts = [f"some words number {i} and more{i}" for i in range(300)]
    encode = ts.PieceEncoder(queries.WORD_VOCABULARY, keep=10)
    assert [list(x) for x in encode(texts)] == [plain_ids(t)[:-1] for t in texts]


def expected(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain_ids(t)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [50, ts.SEGMENT_IDS])
def test_store_of_odd_rows(spark, make_docs, tmp_path, segment_ids):
    rows = [(5, "five"), (-3, None), (2, ""), (11, "long text " * 3_000), (None, "no id"), (7, "same"), (7, "same"), (6, "é中 ß")]
    path = str(tmp_path / "store")
    ts.write_store(make_docs(rows), path, queries.WORD_VOCABULARY, segment_ids=segment_ids)
    got = sorted((tuple(r) for r in ts.read_digests(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_empty_table(spark, make_docs, tmp_path):
    ts.write_store(make_docs([(1, "a")]).filter("doc_id < 0"), str(tmp_path / "none"), queries.WORD_VOCABULARY)
    assert ts.read_digests(spark, str(tmp_path / "none")).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in queries.op5_token_store(spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == expected([tuple(t) for t in texts])


def test_another_vocabulary_has_whole_texts_encoded(spark, make_docs, tmp_path):
    """A byte-level vocabulary that keeps white space: pieces would give other ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not isinstance(ts.encoder(path), ts.PieceEncoder)
    assert isinstance(ts.encoder(queries.WORD_VOCABULARY), ts.PieceEncoder)
    rows = [(1, "Two  words\n and MORE"), (2, None)]
    ts.write_store(make_docs(rows), str(tmp_path / "s"), path)
    got = {r.id: np.frombuffer(r.ids, "<u4").tolist() for r in ts.read_store(spark, str(tmp_path / "s")).collect()}
    known = Tokenizer.from_file(path)
    assert got == {i: known.encode(t or "", add_special_tokens=False).ids + [ts.END_ID] for i, t in rows}


def test_rows_of_one_id_have_a_fixed_order_over_partitions(spark, make_docs, tmp_path):
    rows = [(7, f"text {i}") for i in range(200)] + [(None, f"none {i}") for i in range(100)] + [(7, "text 1")] * 50
    stores = []
    for k, partitions in enumerate((1, 5)):
        path = str(tmp_path / str(k))
        ts.write_store(make_docs(rows, partitions), path, queries.WORD_VOCABULARY)
        found = ts.read_digests(spark, path)
        assert ts.read_store(spark, path).select("part").distinct().count() > 1
        stores.append(sorted((r.start, r.doc_id, r.ids_crc32) for r in found.collect()))
    assert stores[0] == stores[1] and len(stores[0]) == 350
