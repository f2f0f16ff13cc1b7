"""Exact top-k: trees and shards against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import kdtree


def brute(rows, k, query=lambda i: i % 20 == 0):
    points = sorted({(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for i, v in points:
        if query(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in points if j != i and len(w) == len(v))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def test_a_tree_finds_the_best(monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.integers(-20, 20, (500, 6))
    ids = rng.permutation(1_000)[:500]
    tree = kdtree.Tree(points.astype(float), ids, leaf=8)
    assert all(b - a <= 8 for (a, b), c in zip(tree.span, tree.child) if not c)
    queries = rng.integers(-20, 20, (40, 6)).astype(float)
    for q, bound in zip(queries, tree.bounds(queries)):
        for node, (a, b) in enumerate(tree.span):
            assert (tree.points[a:b] @ q).max() <= bound[node]
        want = sorted((-s, i) for s, i in zip(points @ q, ids) if i != ids[0])[:7]
        found, scores = tree.search(q, int(ids[0]), bound, 7, -np.inf)
        assert [(-s, i) for s, i in zip(scores, found)] == want
        found, _ = tree.search(q, int(ids[0]), bound, 7, -want[3][0])
        assert list(found[:4]) == [i for _, i in want[:4]]


@pytest.mark.parametrize("shard_rows", [40, 10**6])
def test_shards_against_brute_force(spark, shard_rows):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 8))
    rows = [(int(i), [float(x) for x in centres[i % 5] + rng.normal(size=8) * 0.2]) for i in rng.permutation(600)]
    got = kdtree.top_k(frame(spark, rows), F.col("id") % 20 == 0, 5, shard_rows=shard_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_more_rows_than_leaves_hold(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "MAX_SHARDS", 4)
    monkeypatch.setattr(kdtree, "SENT_ROWS", 50)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(700)] + [(i, [0.25] * 5) for i in range(700, 900)] + [(i, []) for i in range(900, 1_100)]
    got = kdtree.top_k(frame(spark, rows), F.col("id") % 20 == 0, 6, shard_rows=30)
    assert sorted(map(tuple, got.collect())) == brute(rows, 6)


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "BLOCK", 16)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, 0.25]) for i in range(300)] + [(i, [0.1 * (i % 7), -0.3]) for i in range(300, 420)]
    rows += [(500, None), (520, [nan, 1.0]), (540, [inf, 1.0]), (560, [None, 1.0]), (None, [9.0, 9.0]), (580, [1.0, 2.0, 3.0]), (600, [1.0, 1.0, 1.0]), (620, [5.0]), (0, [0.5, 0.25]), (640, [])]
    got = kdtree.top_k(frame(spark, rows), F.col("id") % 20 == 0, 4, shard_rows=64)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)


def test_very_large_components(spark):
    rows = [(0, [1e17, -1e17]), (1, [1e17, 3.0]), (2, [1.0, 1.0]), (20, [2.0, 3.0])]
    got = {(r.query_id, r.vec_id): r.score for r in kdtree.top_k(frame(spark, rows), F.col("id") % 20 == 0, 3).collect()}
    assert got[(0, 1)] == 2**63 - 1 and got[(20, 2)] == 64 * 64 * 5
    assert got[(20, 1)] == min(2**63 - 1, 128 * int(64 * 1e17) + 192 * 192)


def test_fewer_rows_than_k_and_empty_table(spark):
    rows = [(0, [1.0]), (20, [2.0]), (21, [3.0])]
    assert sorted(map(tuple, kdtree.top_k(frame(spark, rows), F.col("id") % 20 == 0).collect())) == brute(rows, 20)
    assert kdtree.top_k(frame(spark, rows).filter("vec_id < 0"), F.col("id") % 20 == 0).collect() == []
