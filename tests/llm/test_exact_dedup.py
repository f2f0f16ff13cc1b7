"""Exact dedup: decisions, the filter, and the Bloom passes."""

import hashlib
from collections import defaultdict

from indicata.llm import exact_dedup

ROWS = [(1, "same"), (7, "same"), (3, "Same"), (4, None), (9, ""), (None, "same"), (None, "lone"), (5, "twin"), (5, "twin"), (6, "y" * 200_000), (8, "y" * 200_000)]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_decisions(make_docs):
    assert sorted(map(tuple, exact_dedup.decisions(make_docs(ROWS)).collect()), key=repr) == brute(ROWS)


def test_drop_copies_keeps_one_row_of_each_text_and_all_columns(make_docs):
    docs = make_docs(ROWS)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None) == sorted([(7, "same"), (3, "Same"), (9, ""), (5, "twin"), (8, "y" * 200_000)])
    assert [r.text for r in out.collect() if r.doc_id is None] == ["lone"]


def test_a_hot_text_and_many_unique_texts(make_docs):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(3_000)]
    docs = make_docs(rows, 7)
    assert sorted(map(tuple, exact_dedup.decisions(docs).collect()), key=repr) == brute(rows)
    assert exact_dedup.drop_copies(docs).count() == 2_001


def test_unique_rows_pass_and_repeated_rows_never_do(make_docs, spark):
    docs = make_docs([(i, f"text {i % 900}") for i in range(1_000)])
    light = docs.select("doc_id", exact_dedup._digest("text").alias("digest"), "text")
    flagged = exact_dedup.flag_possible_repeats(light, light).collect()
    assert all(r.repeated for r in flagged if int(r.text.split()[1]) < 100)
    assert sum(r.repeated for r in flagged if int(r.text.split()[1]) >= 100) < 40


def test_a_full_filter_is_still_right(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_FILTER_BYTES", 4096)
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 32_768)
    rows = [(i, f"text {i % 7_000}") for i in range(8_000)]
    assert sorted(map(tuple, exact_dedup.decisions(make_docs(rows)).collect()), key=repr) == brute(rows)


def test_empty_table_and_clashing_columns(make_docs, spark):
    empty = make_docs([(1, "a")]).filter("doc_id < 0")
    assert exact_dedup.decisions(empty).collect() == [] and exact_dedup.drop_copies(empty).collect() == []
    odd = spark.createDataFrame([(1, "a", 1, 2, 3), (2, "a", 4, 5, 6)], "doc_id long, text string, digest int, `block` int, `row` int")
    assert [tuple(r) for r in exact_dedup.drop_copies(odd).collect()] == [(2, "a", 4, 5, 6)]


def test_no_python_in_the_plan(make_docs):
    plan = exact_dedup.decisions(make_docs(ROWS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
