"""The corpus pipeline, the registered queries and their SQL."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from indicata.llm import bpe, queries, simhash
from tests.oracle_check import _family, _norm, spark_types


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, duck_docs, sf_dir, key):
    df = queries.QUERIES[key](spark, sf_dir)
    rel = duck_docs.sql(queries.ORACLE_SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    types = spark_types(df)
    assert {c: types[c] for c in df.columns} == {c: _family(str(t)) for c, t in zip(rel.columns, rel.types)}
    order = sorted(df.columns)
    norm = lambda rows, cols: sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    assert norm([tuple(r) for r in df.collect()], list(df.columns)) == norm(rel.fetchall(), list(rel.columns))


def test_stages_work_on_what_is_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    frames = [docs]
    for name, function in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.stage(function(spark, frames[-1], sf_dir), f"test-{name}"))
    rows = [f.collect() for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])

    scores = {r.doc_id: r.score for r in queries.op3_toxicity(spark, sf_dir).collect()}
    assert {r.doc_id for r in rows[1]} == {i for i, s in scores.items() if s < 0.7}
    best = {}
    for r in rows[1]:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in rows[2]} == set(best.values())
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows[2]}
    component = {r.doc_id: r.component_id for r in simhash.groups(frames[2]).collect()}
    assert {r.doc_id for r in rows[3]} == set(component.values())
    for i, p in prints.items():
        assert all(component[i] == component[j] for j, q in prints.items() if (p ^ q).bit_count() <= 4)
    assert set(rows[4]) == set(rows[3])  # every document stays, some are repeated
    enc = bpe.encoding(queries.BYTE_RANKS, public_tokenizers.PATTERN)

    def digest(r):
        ids = np.array(enc.encode_ordinary(r.text), "<u4")
        return r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()

    assert Counter(map(tuple, rows[5])) == Counter(map(digest, rows[4]))
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(tuple, rows[5]))


def test_stages_take_odd_and_empty_tables(spark, make_docs, stored, sf_dir):
    docs = stored(make_docs([(1, None), (2, ""), (2, ""), (None, "abc"), (3, "word " * 20_000), (4, "word " * 20_000)]))
    docs = stored(docs.selectExpr("*", "1 AS score", "'k' AS row"))
    empty = docs.filter("doc_id > 10")
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, sf_dir).collect() == []
        docs = corpus_pipeline.stage(function(spark, docs, sf_dir), f"odd-{name}")
    assert sorted({r.doc_id is None or r.doc_id for r in docs.collect()}) == [True, 2, 4] or len({r.doc_id for r in docs.collect()}) == 3
