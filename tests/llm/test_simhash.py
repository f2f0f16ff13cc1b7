"""SimHash groups against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import queries, simhash


def plain_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, bits=4):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least.get(root(i)) for i in range(len(prints))]


@given(st.text(alphabet="aAbZé \t\n\x0b\x1c\xa0", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_long_text():
    rng = random.Random(3)
    text = " ".join(rng.choice(["ab", "Cd", "efg", "h"]) for _ in range(70_000))
    hashes = [xxhash.xxh64_intdigest(" ".join(w).encode(), seed=42) for w in zip(*[text.lower().split()[i:] for i in range(4)])]
    ones = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int)
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(hashes))


def near(rng, n, families, spread):
    """Fingerprints in chains and clusters, as signed longs."""
    out = []
    for _ in range(families):
        x = rng.getrandbits(64)
        for _ in range(n):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(0, spread)):
                x ^= 1 << b
    return sorted({x - (1 << 64) if x >> 63 else x for x in out})


@pytest.mark.parametrize("max_bits,blocks", [(4, 6), (4, 5), (4, 3), (4, 1), (4, 2), (3, 3), (0, 3)])
def test_links_connect_exactly_the_pairs(spark, max_bits, blocks):
    rng = random.Random(max_bits * 10 + blocks)
    prints = near(rng, 12, 25, max_bits + 2) + [0, 1, 3]
    prints = sorted(set(prints))
    unique = spark.createDataFrame([(x,) for x in prints], "fp long")
    edges = simhash.links(unique, max_bits, blocks, shard_rows=16)
    for a, b in edges.collect():
        assert a < b and a in prints and b in prints
    got = {r.node: r.root for r in simhash.components(edges, spark).collect()}
    want = plain_components([x % (1 << 64) for x in prints], prints, max_bits)
    assert {x: got.get(x, x) for x in prints} == dict(zip(prints, want))


@pytest.mark.parametrize("max_bits,blocks", [(4, 6), (4, 5), (3, 5), (4, 3), (2, 4)])
def test_pairs_meet_on_a_band(max_bits, blocks):
    masks, radius = simhash.band_masks(blocks, max_bits)
    rng = random.Random(blocks)
    for _ in range(2_000):
        differing = np.uint64(sum(1 << b for b in rng.sample(range(64), max_bits)))
        assert min(int(np.bitwise_count(differing & m)) for m in masks) <= radius


def test_copies_do_not_grow_with_the_depth_and_shards_stay_even():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 1 << 64, 40_000, dtype=np.uint64)
    masks, radius = simhash.band_masks()
    assert len(masks) == 15 and radius == 0
    for depth in (3, 5, 7, 9, 11):
        for mask in masks[:3]:
            shard, idx, home = simhash.route(points, simhash.build_tree(points[:5_000], mask, radius, depth), mask, radius)
            assert home.all() and sorted(idx) == list(range(len(points)))
            assert shard.min() >= 0 and shard.max() < 1 << depth
            rows = np.bincount(shard, minlength=1 << depth)
            assert (rows**2).sum() / rows.sum() < 4 * len(points) / (1 << depth) + 50


def test_a_point_visits_every_shard_where_a_partner_lies():
    rng = random.Random(9)
    for max_bits, blocks in ((4, 3), (4, 6), (4, 1)):
        masks, radius = simhash.band_masks(blocks, max_bits)
        xs = [rng.getrandbits(64) for _ in range(400)]
        points = np.array(xs + [x ^ sum(1 << b for b in rng.sample(range(64), max_bits)) for x in xs], np.uint64)
        met = set()
        for mask in masks:
            shard, idx, home = simhash.route(points, simhash.build_tree(points, mask, radius, 5), mask, radius)
            own = {int(i): int(s) for s, i, h in zip(shard, idx, home) if h}
            visits = {(int(s), int(i)) for s, i in zip(shard, idx)}
            met |= {i for i in range(400) if (own[i], i + 400) in visits and int(np.bitwise_count((points[i] ^ points[i + 400]) & mask)) <= radius}
            assert all((own[i], i + 400) in visits for i in range(400) if int(np.bitwise_count((points[i] ^ points[i + 400]) & mask)) <= radius)
        assert len(met) == 400


def test_shard_forest_of_a_dense_cluster():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    points = np.unique(np.array([base ^ np.uint64(1 << i) ^ np.uint64(1 << j) for i in range(64) for j in range(i)], np.uint64))
    held, simhash.HELD_LINKS = simhash.HELD_LINKS, 5_000
    try:
        a, b = simhash.shard_forest(points, np.ones(len(points), bool), simhash.band_masks(3, 4)[0][0], 1, 4)
    finally:
        simhash.HELD_LINKS = held
    assert len(a) == len(points) - 1
    assert (simhash.local_components(len(points), a, b) == 0).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges, spark).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_groups_with_odd_rows(make_docs):
    body = " ".join(f"word{i}" for i in range(80))
    rows = [(5, body), (3, body.upper()), (9, None), (2, ""), (7, "  \n"), (None, body), (None, "alone in the world"), (4, "one two"), (4, "one two"), (8, "x " * 5000)]
    docs = make_docs(rows)
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.groups(docs).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components(prints, [i for i, _ in rows])
    assert got == {(i, f"{p:016x}"): c for (i, _), p, c in zip(rows, prints, want)}
    assert simhash.groups(docs).count() == len(rows)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 3), (False, 4), (False, 4), (False, 8), (True, 0)]


def test_one_document_of_each_group_with_repeated_and_null_ids(make_docs):
    body, other, third = (" ".join(f"{w}{i}" for i in range(80)) for w in ("word", "line", "part"))
    rows = [(3, body), (3, body.upper()), (3, "  " + body), (6, body + " "), (None, other), (None, other.upper()), (None, third), (9, "alone in the world")]
    kept = sorted(((r.doc_id or 0), r.text.strip().lower()) for r in simhash.drop_near_copies(make_docs(rows)).collect())
    assert kept == sorted([(3, body), (0, other), (0, third), (9, "alone in the world")])


def test_empty_table(make_docs, spark):
    docs = make_docs([(1, "a")]).filter("doc_id < 0")
    assert simhash.groups(docs).collect() == []
    assert simhash.drop_near_copies(docs).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op4_simhash(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    want = plain_components(prints, [i for i, _ in texts])
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{p:016x}", c) for (i, _), p, c in zip(texts, prints, want)}
