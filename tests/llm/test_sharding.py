"""Extendible hashing: shards fit, splits are minimal, hot keys split."""

import hashlib
from collections import defaultdict

import pytest

from indicata.llm import sharding


def shards(spark, docs, tmp_path, limit, **options):
    path = str(tmp_path / "s")
    sharding.write_shards(docs, path, limit=limit, **options)
    return sharding.placements(spark, path, docs, limit=limit).collect(), path


def brute_depths(codes, limit):
    """{code: depth} by splitting a directory on one more bit wherever it is too full."""
    out = {}

    def split(rows, depth):
        if sum(b for _, b in rows) > limit and len(rows) > 1 and depth < sharding.BITS:
            for bit in (0, 1):
                split([r for r in rows if r[0] >> (sharding.BITS - 1 - depth) & 1 == bit], depth + 1)
        else:
            out.update({c: depth for c, _ in rows})

    split(codes, 0)
    return out


@pytest.mark.parametrize("limit", [300, 2_000, 10**9])
def test_only_oversized_buckets_split(spark, make_docs, stored, tmp_path, limit):
    docs = stored(make_docs([(i, "x" * (i % 37)) for i in range(400)], 4))
    rows, path = shards(spark, docs, tmp_path, limit)
    stored_rows = sharding.read_shards(spark, path, docs).select("code", "bytes", "depth", "shard").collect()
    assert len(rows) == len(stored_rows) == 400
    want = brute_depths([(r.code, r.bytes) for r in stored_rows], limit)
    assert {r.code: r.depth for r in stored_rows} == want
    assert all(r.shard == "b" + f"{r.code:060b}"[: r.depth] for r in stored_rows)
    assert not any(r.oversized for r in rows) and all(r.shard_bytes <= limit for r in rows)


def test_codes_are_a_prefix_of_md5(spark, make_docs, stored, tmp_path):
    docs = stored(make_docs([(i, "abc") for i in range(50)]))
    _, path = shards(spark, docs, tmp_path, 20)
    for r in sharding.read_shards(spark, path, docs).select("code", "row.doc_id").collect():
        assert r.code >> 20 == int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:10], 16)


def test_a_hot_key_is_split_and_a_large_row_stands_alone(spark, make_docs, stored, tmp_path):
    docs = stored(make_docs([(7, "x" * 10)] * 300 + [(i, "y" * 10) for i in range(100)] + [(5000, "z" * 1_000)] + [(None, "n" * 10)] * 20, 3))
    rows, _ = shards(spark, docs, tmp_path, 200)
    assert len(rows) == 421
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.bytes
    assert {r.doc_id for r in rows if r.oversized} == {5000}
    assert all(v <= 200 for k, v in size.items() if k not in {r.shard for r in rows if r.doc_id == 5000})
    assert len({r.shard for r in rows if r.doc_id == 7}) >= 15


def test_null_texts_empty_table_and_clashing_columns(spark, make_docs, stored, tmp_path):
    odd = stored(spark.createDataFrame([(1, None, "a", 1, 2, 3), (2, "tt", None, 4, 5, 6)], "doc_id long, text string, shard string, depth int, bytes int, code int"))
    path = str(tmp_path / "odd")
    sharding.write_shards(odd, path, limit=1)
    assert sorted(tuple(r.row) for r in sharding.read_shards(spark, path, odd).collect()) == [(1, None, "a", 1, 2, 3), (2, "tt", None, 4, 5, 6)]
    assert sorted((r.doc_id, r.bytes) for r in sharding.placements(spark, path, odd).collect()) == [(1, 0), (2, 2)]
    rows, _ = shards(spark, stored(make_docs([(1, "a")]).filter("doc_id < 0")), tmp_path, 10)
    assert rows == []


def test_sql_agrees_with_many_shards(spark, duck_docs, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, _ = shards(spark, docs, tmp_path, 20_000)
    rel = duck_docs.sql(sharding.oracle_sql(20_000))
    order = [rel.columns.index(c) for c in ("doc_id", "shard", "depth", "bytes", "shard_bytes", "shard_rows", "oversized")]
    assert sorted(map(tuple, rows)) == sorted(tuple(r[i] for i in order) for r in rel.fetchall())
