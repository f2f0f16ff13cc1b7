"""Byte-level BPE: chunked encoding equals whole-text encoding."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import bpe, queries

RANKS, PATTERN = queries.BYTE_RANKS, public_tokenizers.PATTERN
ENC = bpe.encoding(RANKS, PATTERN)
ALPHABET = st.sampled_from(list("ab'strevmld0 \n\t.!") + ["é", "ß", "中", "́", "\xa0", "😀", "'re", " \n ", "   "])


def digest(text):
    ids = ENC.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@given(st.lists(ALPHABET, max_size=200).map("".join), st.integers(4, 24), st.integers(1, 24))
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_ids_of_the_whole(text, chunk, overlap):
    assert bpe.encode_text(text, RANKS, PATTERN, chunk, min(overlap, chunk)) == ENC.encode_ordinary(text)


def test_pieces_are_stitched_where_both_sides_agree():
    text = "the quick brown fox jumps over the lazy dog " * 40
    chunks = bpe.cut(text, 100, 30)
    assert len(chunks) > 10 and None not in bpe.stitches(chunks, PATTERN, 100, 30)
    assert None in bpe.stitches(bpe.cut("a" * 1000, 100, 30), PATTERN, 100, 30)


@pytest.mark.parametrize("chunk,overlap", [(200, 40), (bpe.CHUNK, bpe.OVERLAP)])
def test_documents(make_docs, stored, chunk, overlap):
    words = " ".join(f"word{i}, it's {i}!" for i in range(6_000))
    rows = [(1, words), (2, None), (3, ""), (4, "z" * 40_000 + " end"), (5, " " * 40_000 + "x"), (6, "short"), (6, "short"), (None, words), (None, None), (7, "é中́😀 " * 8_000)]
    docs = stored(make_docs(rows))
    got = bpe.digests(bpe.encode(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap), RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *digest(t)) for i, t in rows), key=repr)


@pytest.mark.parametrize("blanks", [" ", "\n", " \n\t", "\u3000 "])
def test_very_long_runs_of_blanks(blanks):
    """Two million blanks overflow the library; the ids are those of the pre-tokens, each encoded by itself."""
    run = blanks * (2_000_000 // len(blanks))
    for text in (run, "word" + run, run + "word", f"a, b{run}c d{run}! {run}"):
        want = [i for m in bpe.splitter(PATTERN).finditer(text) for i in ENC._encode_single_piece(m.group())]
        assert bpe.encode_text(text, RANKS, PATTERN) == want
        other = PATTERN.replace("|\\s+(?!\\S)", "|\\s+?(?=x)|\\s+(?!\\S)")
        assert bpe.encode_whole(bpe.encoding(RANKS, other), other, text) == want
    short = "a b" + blanks * 5_000 + "c  d" + blanks * 6_000
    assert bpe.encode_whole(ENC, PATTERN, short) == ENC.encode_ordinary(short)


def test_documents_of_blanks(make_docs, stored):
    rows = [(1, " " * 1_200_000 + "x"), (2, "\n" * 1_200_000), (3, "plain")]
    got = bpe.digests(bpe.encode(stored(make_docs(rows)), RANKS, PATTERN), RANKS, PATTERN).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}


def test_other_columns_pass_and_may_clash(spark, stored):
    odd = stored(spark.createDataFrame([(1, "a b " * 9_000, "k", 5, "r"), (2, "c", None, 6, None)], "doc_id long, text string, `key` string, `no` int, `row` string"))
    rows = bpe.encode(odd, RANKS, PATTERN).select("row.*").collect()
    assert sorted(map(tuple, rows)) == [(1, "k", 5, "r"), (2, None, 6, None)]


def test_empty_table(make_docs):
    assert bpe.digests(bpe.encode(make_docs([(1, "a")]).filter("doc_id < 0"), RANKS, PATTERN), RANKS, PATTERN).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op7_bpe(spark, sf_dir).collect()))
    assert got == sorted((i, *digest(t)) for i, t in texts)
