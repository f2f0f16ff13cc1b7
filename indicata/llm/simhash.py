"""SimHash near-duplicate groups found with vantage-point trees.

Fingerprints. Text is lower-cased (A-Z only) and cut into words at ASCII white
space; every run of ``shingle`` words, repeats included, is hashed with XXH64
(seed 42). Bit i of the fingerprint is 1 if more than half the hashes set it.

Exact pair search. The 64 bits are cut into ``BLOCKS`` disjoint blocks. Of two
fingerprints with at most ``max_bits`` differing bits at least
``BLOCKS - max_bits`` blocks are equal, so they are equal on one of the bands
that so many blocks make (with fewer blocks than that, they differ in at most
``max_bits // BLOCKS`` bits of one block). Hamming distance on a band is a
metric, so each band gets a vantage-point tree: an inner node holds a vantage
point v and a distance mu, and splits into the ball d(v, x) <= mu and its
outside. The leaves are the shards. A fingerprint has one home shard; by the
triangle inequality its partners at radius r on the band live on the left only
if d <= mu + r and on the right only if d > mu - r, so it also visits the
shards whose boundary it overlaps and no other. At radius 0 no boundary is
overlapped: a fingerprint lies in one shard of each band, whatever the depth
of the trees, so copies do not grow with the corpus. Inside a shard the same
tree search goes on in numpy until blocks are small, and the blocks are
compared on all 64 bits. No pair is missed and none is approximated.

The upper levels of the trees are fitted on a bounded sample of fingerprints
(``SAMPLE``), which only steers balance; the nodes of each level below share a
vantage point drawn by rule, so the trees held in memory have a fixed size
however many shards there are. A shard returns a spanning forest of its links, not all
pairs of a group. Components come from repeated contraction of the links.

Defined results: null or blank text has no words and gets fingerprint zero,
which links like any other; fewer words than a shingle make one shingle of
them all. Rows with a null id get a fingerprint and the component id of their
group; that is null only if the whole group lacks ids. Repeated rows share a
group. An empty table gives an empty result. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm.common import stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Blocks of the fingerprint: with 4 differing bits two of six are equal, so 15 bands of 21 or 22 bits at radius 0.
BLOCKS = 6
#: Fingerprints per home shard that the depth of the trees aims at, and the least depth.
SHARD_ROWS = 32_768
LEAST_DEPTH = 3
#: Levels of a tree that are fitted on the sample.
FITTED_DEPTH = 9
#: Most fingerprints in the sample on which the trees are fitted.
SAMPLE = 20_000
#: A block of the search in a shard is compared directly at this many pairs.
BLOCK_PAIRS = 1 << 16
#: Links held in a shard before they are reduced to a spanning forest.
HELD_LINKS = 1 << 21


# --- fingerprints -------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    xxh = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return xxh(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - shingle + 1
    hashes = np.fromiter((xxh(joined[i:j], SEED) for i, j in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        bits = np.unpackbits(hashes[k : k + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_key, fp): the id, XXH64 of the whole text, and the fingerprint as a signed long."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_key"), pa.array(fp.view(np.int64))], ["id", "text_key", "fp"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, text_key long, fp long")


# --- vantage-point trees ---------------------------------------------------------


def band_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> tuple[np.ndarray, int]:
    """Masks of 64 bits and the radius at which any two fingerprints within ``max_bits`` meet on one of them."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    together = max(1, blocks - max_bits)
    return np.array([sum(c) for c in combinations(single, together)], np.uint64), max_bits // blocks


def distances(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask).astype(np.int16)


def choose_vantage(points: np.ndarray, mask: np.uint64, radius: int) -> tuple[np.uint64, int]:
    """Vantage point and median distance; of a few candidates the one whose boundary the fewest points overlap."""
    best: tuple[float, np.uint64, int] | None = None
    for v in points[:: max(1, len(points) // 8)][:8]:
        d = distances(points, v, mask)
        mu = int(np.median(d))
        left = float((d <= mu).mean())
        overlap = float(((d > mu - radius) & (d <= mu + radius)).mean()) + abs(left - 0.5)
        if best is None or overlap < best[0]:
            best = (overlap, v, mu)
    return (best[1], best[2]) if best else drawn_vantage(0, mask)


def drawn_vantage(level: int, mask: np.uint64) -> tuple[np.uint64, int]:
    """A vantage point that needs no sample: a hash of the level, and the distance that halves even bits."""
    return np.uint64(xxhash.xxh64_intdigest(f"vantage {level}")), (int(np.bitwise_count(mask)) - 1) // 2


def build_tree(sample: np.ndarray, mask: np.uint64, radius: int, depth: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.uint64, int]]]:
    """A complete tree in level order: children of node i are 2i+1 (ball) and 2i+2 (outside).

    Vantage points and distances of the nodes of the first ``FITTED_DEPTH``
    levels, then one of each for every level below.
    """
    size = (1 << min(depth, FITTED_DEPTH)) - 1
    vantage, mu = np.zeros(size, np.uint64), np.zeros(size, np.int16)
    parts = {0: sample}
    for node in range(size):
        points = parts.pop(node)
        vantage[node], mu[node] = choose_vantage(points, mask, radius)
        near = distances(points, vantage[node], mask) <= mu[node]
        parts[2 * node + 1], parts[2 * node + 2] = points[near], points[~near]
    return vantage, mu, [drawn_vantage(level, mask) for level in range(FITTED_DEPTH, depth)]


def route(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray, list[tuple[np.uint64, int]]], mask: np.uint64, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index, home): every shard that each point overlaps; ``home`` marks the one it lies in."""
    vantage, mu, below = tree
    node, idx, home = np.zeros(len(points), np.int64), np.arange(len(points)), np.ones(len(points), bool)
    fitted = len(vantage).bit_length()
    for level in range(fitted + len(below)):
        v, m = (vantage[node], mu[node]) if level < fitted else below[level - fitted]
        d = distances(points[idx], v, mask)
        near = d <= m
        left, right = d <= m + radius, d > m - radius
        node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        home = np.concatenate([(home & near)[left], (home & ~near)[right]])
        idx = np.concatenate([idx[left], idx[right]])
    return node - ((1 << (fitted + len(below))) - 1), idx, home


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def shard_forest(points: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as indexes of ``points``) that span the components of all pairs of a home point and any point within ``max_bits``."""
    n = len(points)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def reduce() -> None:
        nonlocal held, count
        label = local_components(n, np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        child = np.flatnonzero(label != np.arange(n))
        held, count = [(child, label[child])], 0

    stack = [(np.flatnonzero(home), np.arange(n))]
    while stack:
        own, visit = stack.pop()
        if not len(own) or not len(visit):
            continue
        if len(own) * len(visit) > BLOCK_PAIRS:
            v, mu = choose_vantage(points[own], mask, radius)
            d, e = distances(points[own], v, mask), distances(points[visit], v, mask)
            near = d <= mu
            if 0 < near.sum() < len(own):
                stack.append((own[near], visit[e <= mu + radius]))
                stack.append((own[~near], visit[e > mu - radius]))
                continue
        rows = max(1, (1 << 20) // len(visit))
        for k in range(0, len(own), rows):  # a block of equal distances can be large: compared in strips
            part = own[k : k + rows]
            i, j = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[visit][None, :]) <= max_bits)
            x, y = part[i], visit[j]
            held.append((x[x != y], y[x != y]))
            count += len(held[-1][0])
            if count > HELD_LINKS:
                reduce()
    if held:
        reduce()
    return held[0] if held else (np.empty(0, int), np.empty(0, int))


def links(unique: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect exactly the pairs within ``max_bits``.

    ``unique``: one row per distinct fingerprint, column ``fp``.
    """
    n = unique.count()
    part = max(16, -(-n // SAMPLE))  # the sample is one in ``part`` by hash, so SAMPLE rows on average at most
    rows = unique.filter(F.pmod(F.xxhash64("fp", F.lit("vantage")), F.lit(part)) == 0).limit(2 * SAMPLE).collect()
    sample = np.sort(np.array([r.fp for r in rows], np.int64).view(np.uint64))
    depth = max(least_depth, int(np.ceil(np.log2(max(1, n / shard_rows)))))
    masks, radius = band_masks(blocks, max_bits)
    trees = [build_tree(sample, m, radius, depth) for m in masks]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = b.column("fp").to_numpy().view(np.uint64)
            for t, (tree, mask) in enumerate(zip(trees, masks)):
                shard, idx, home = route(points, tree, mask, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), t, np.int32)), pa.array(shard), pa.array(points[idx].view(np.int64)), pa.array(home)],
                    ["tree", "shard", "fp", "home"],
                )

    def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        a, b = shard_forest(points, pdf["home"].to_numpy(bool), masks[int(key[0])], radius, max_bits)
        return pd.DataFrame({"a": points[a].view(np.int64), "b": points[b].view(np.int64)})

    routed = unique.select("fp").mapInArrow(assign, "tree int, shard long, fp long, home boolean")
    found = routed.groupBy("tree", "shard").applyInPandas(search, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# --- components --------------------------------------------------------------------


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Each round points every node to its smallest neighbour, follows pointers
    twice and contracts the links; at least half the nodes with links go in
    a round, and every round is written, so none is recomputed.
    """
    edges = stage(edges, "links")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "links-up")
        for _ in range(2):
            over = up.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            up = up.join(over, "root").select("node", F.col("higher").alias("root"))
        up = stage(up, "links-root")
        maps.append(up)
        moved = edges.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        edges = stage(moved.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for up in maps[1:]:
        higher = up.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        out = out.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
    return out


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, text_key, fp, root, component_id): one row per row of ``docs``; ``root`` tells groups apart, also those without ids."""
    spark = docs.sparkSession
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    unique = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-unique")
    roots = stage(components(links(unique, max_bits), spark).select(F.col("node").alias("fp"), "root"), "simhash-roots")
    least = stage(
        roots.join(unique, "fp").groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least"
    )
    linked = roots.join(least, "root").select("fp", "root", "component_id")
    merged = stage(unique.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")), "simhash-groups")
    return prints.join(merged, "fp")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, text_key, fingerprint (16 hex digits), component_id."""
    out = _grouped(docs, id_col, text_col, shingle, max_bits)
    return out.select(F.col("id").alias(id_col), "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest (id, text key), null ids last.

    Rows that repeat that id and text are the same document and stay; they are
    for exact dedup.
    """
    out = stage(_grouped(docs, id_col, text_col, shingle, max_bits).select("id", "text_key", "root"), "simhash-rows")
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("text_key"))
    first = stage(out.groupBy("root").agg(F.min(place).alias("first")), "simhash-first")
    other = ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key")))
    gone = stage(out.join(first, "root").filter(other).select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct(), "simhash-gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = F.xxhash64(F.coalesce(F.col("row").getField(text_col), F.lit("")))
    kept = rows.join(gone, F.col("row").getField(id_col).eqNullSafe(F.col("gone_id")) & (key == F.col("gone_key")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
