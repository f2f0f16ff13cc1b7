"""Exact top-k inner-product search with a KD-tree in every shard.

Vectors are turned into integers, floor(64 * x), and dealt to shards by a
coarse KD-tree (median splits on the axis of largest spread) that is fitted on
a bounded sample (``SAMPLE`` rows); it only steers which rows lie together.
Inside a shard the rows form a KD-tree of median splits whose nodes carry
their tight bounding boxes. A box bounds the inner product of any point in it
with query q by sum(max(q_i * low_i, q_i * high_i)); the tree is walked best
bound first and the walk ends when the best open bound is below the query's
kth score so far.

1. Every query searches its own shard.
2. The kth score found is propagated: the query is sent only to other shards
   whose box bound reaches it, and starts there from that score.
3. The partial results, at most k for each query and shard, are merged.

Queries are dealt to a shard in blocks of ``BLOCK`` rows, so neither a shard
nor its queries outgrow a task; a vector that very many rows share is kept
with its k + 1 smallest ids only, which are the only ones that can be among
the k best (ties go to smaller ids). All results are exact.

The boxes are held by the driver, so the coarse tree has at most ``MAX_SHARDS``
leaves; beyond that many rows each leaf is dealt by a hash of the id to as many
shards as keep them at ``shard_rows``, which share the leaf's box.

Defined results: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part. Vectors are compared with vectors of
the same length. Rows that repeat id and vector count once; a query never
finds rows of its own id. Scores beyond 64 bits are cut to the largest long.
An empty table gives an empty result. Extra columns are not used.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicata.llm.common import stage

SCALE = 64
SHARD_ROWS = 8_192
LEAF_ROWS = 128
BLOCK = 1_024
SAMPLE = 20_000
MAX_SHARDS = 4_096
#: Rows of one batch of queries on their way to other shards.
SENT_ROWS = 65_536
LONG = np.iinfo(np.int64)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


# --- trees -----------------------------------------------------------------------


def split_axis(points: np.ndarray) -> tuple[int, float] | None:
    """Axis of largest spread and its median; None if all points are equal."""
    if not points.shape[1] or len(points) < 2:
        return None
    low, high = points.min(axis=0), points.max(axis=0)
    axis = int(np.argmax(high - low))
    if low[axis] == high[axis]:
        return None
    middle = float(np.median(points[:, axis]))
    return axis, middle if middle < high[axis] else math.nextafter(float(high[axis]), -math.inf)


class Tree:
    """KD-tree over integer rows: arrays of nodes with tight boxes; leaves are slices of ``order``."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS) -> None:
        order = np.arange(len(points))
        low, high, child, span = [], [], [], []
        stack = [(0, len(points), -1)]
        while stack:
            a, b, parent = stack.pop()
            own = points[order[a:b]]
            node = len(low)
            low.append(own.min(axis=0) if b > a else np.zeros(points.shape[1]))
            high.append(own.max(axis=0) if b > a else np.zeros(points.shape[1]))
            span.append((a, b))
            child.append([])
            if parent >= 0:
                child[parent].append(node)
            found = split_axis(own) if b - a > leaf else None
            if found:
                near = own[:, found[0]] <= found[1]
                order[a:b] = np.concatenate([order[a:b][near], order[a:b][~near]])
                cut = a + int(near.sum())
                stack += [(cut, b, node), (a, cut, node)]
        self.low, self.high = np.array(low, np.float64), np.array(high, np.float64)
        self.child, self.span = child, span
        self.points, self.ids = points[order], ids[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, nodes): no point of the node scores higher."""
        return box_bounds(queries, self.low, self.high)

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, kth: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of at most k best points that score ``kth`` or more, best first."""
        ids, scores = np.empty(0, np.int64), np.empty(0, self.points.dtype)
        heap = [(-bound[0], 0)]
        while heap:
            best, node = heapq.heappop(heap)
            if -best < kth:
                break
            if self.child[node]:
                for c in self.child[node]:
                    if bound[c] >= kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            a, b = self.span[node]
            new = self.points[a:b] @ query
            ok = (new >= kth) & (self.ids[a:b] != own)
            if not ok.any():
                continue
            ids, scores = np.concatenate([ids, self.ids[a:b][ok]]), np.concatenate([scores, new[ok]])
            if len(ids) >= k:
                keep = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[keep], scores[keep]
                kth = max(kth, float(scores[-1]))
        keep = np.lexsort((ids, -scores))[:k]
        return ids[keep], scores[keep]


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    q = queries.astype(np.float64)
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of longs."""
    return np.stack(column.to_numpy()).astype(np.int64) if len(column) else np.empty((0, 0), np.int64)


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """float64 where every inner product is exact in it, else Python integers."""
    top = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return np.float64 if top(a) * top(b) * max(1, a.shape[1]) < 2**53 else object


def search_block(candidates: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query index, ids, scores) of the best candidates of each query."""
    kind = exact_type(candidates, queries)
    tree = Tree(candidates.astype(kind), ids)
    bounds = tree.bounds(queries)
    if kind is object:  # bounds are rounded: leave room
        bounds = bounds + np.abs(bounds) * 1e-9 + 1
    for i, q in enumerate(queries.astype(kind)):
        found, scores = tree.search(q, int(own[i]), bounds[i], k, float(kth[i]))
        yield i, found, np.array([min(max(int(s), LONG.min), LONG.max) for s in scores], np.int64)


# --- shards -----------------------------------------------------------------------


def coarse_tree(sample: np.ndarray, depth: int) -> list[tuple[int, float] | None]:
    """Level-order splits for routing; None sends every row to the left."""
    nodes: list[tuple[int, float] | None] = []
    parts = {0: sample}
    for node in range((1 << depth) - 1):
        own = parts.pop(node)
        found = split_axis(own) if len(own) > 1 else None
        nodes.append(found)
        near = own[:, found[0]] <= found[1] if found else np.ones(len(own), bool)
        parts[2 * node + 1], parts[2 * node + 2] = own[near], own[~near]
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, float] | None]) -> np.ndarray:
    """Shard of each row."""
    at = np.zeros(len(points), np.int64)
    depth = (len(nodes) + 1).bit_length() - 1
    for level in range(depth):
        for node in range((1 << level) - 1, (1 << (level + 1)) - 1):
            own = np.flatnonzero(at == node)
            found = nodes[node]
            right = points[own, found[0]] > found[1] if found else np.zeros(len(own), bool)
            at[own] = 2 * node + 1 + right
    return at - len(nodes)


def _search_dimension(points: DataFrame, dim: int, is_query: Column, k: int, shard_rows: int) -> DataFrame:
    spark = points.sparkSession
    # Plain rank limits, which Spark also applies before the shuffle: of a
    # vector that very many rows share, each task sends k + 1 ids only.
    best = Window.partitionBy("v").orderBy("id")
    rows = points.distinct()
    closest = rows.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1).select("id", "v")
    n = points.count()
    part = max(16, -(-n // SAMPLE))
    sample = points.filter(F.pmod(F.xxhash64("id", F.lit("kd")), F.lit(part)) == 0).select("v").limit(2 * SAMPLE).collect()
    depth = min(max(1, math.ceil(math.log2(max(1, n / shard_rows)))), int(math.log2(MAX_SHARDS)))
    parts = max(1, -(-n // (shard_rows << depth)))
    nodes = coarse_tree(np.array([r.v for r in sample], np.int64).reshape(len(sample), dim), depth)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v").flatten().to_numpy().reshape(b.num_rows, dim)
            shard = route(v, nodes) * parts + b.column("part").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(shard), b.column("id"), b.column("v")], ["shard", "id", "v"])

    placed, part_of = "shard long, id long, v array<long>", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("long")
    candidates = stage(closest.withColumn("part", part_of).mapInArrow(assign, placed), "kd-candidates")
    queries = stage(rows.filter(is_query).withColumn("part", part_of).mapInArrow(assign, placed), "kd-queries").withColumn("kth", F.lit(float("-inf")))

    first = stage(_search(candidates, queries, k), "kd-own")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = first.groupBy("query_id").agg(F.when(F.count("vec_id") >= k, F.min("score")).alias("kth"))
    started = queries.drop("kth").join(kth.withColumnRenamed("query_id", "id"), "id", "left").select("shard", "id", "v", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("kth"))

    def box(pdf: pd.DataFrame) -> pd.DataFrame:
        v = matrix(pdf["v"])
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "low": [v.min(axis=0).tolist()], "high": [v.max(axis=0).tolist()]})

    boxes = candidates.groupBy("shard").applyInPandas(box, "shard long, low array<long>, high array<long>")
    if parts > 1:  # of a leaf's shards one box, side by side
        sides = boxes.select(F.floor(F.col("shard") / parts).alias("shard"), F.posexplode_outer(F.arrays_zip("low", "high")).alias("axis", "side"))
        sides = sides.groupBy("shard", "axis").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
        merged = sides.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("box"))
        boxes = merged.select("shard", F.col("box.low").alias("low"), F.col("box.high").alias("high"))
    boxes = boxes.collect()  # MAX_SHARDS rows at most
    leaves = np.array([b.shard for b in boxes], np.int64)
    low, high = (np.array([getattr(b, x)[:dim] for b in boxes], np.float64).reshape(len(boxes), dim) for x in ("low", "high"))
    strip = max(1, SENT_ROWS // max(1, len(leaves) * parts))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, strip):
                b = whole.slice(start, strip)
                v = b.column("v").flatten().to_numpy().reshape(b.num_rows, dim)
                bound = box_bounds(v, low, high)
                bound += np.abs(bound) * 1e-9
                i, leaf = np.nonzero(bound >= b.column("kth").to_numpy()[:, None])
                i, shard = np.repeat(i, parts), (leaves[leaf][:, None] * parts + np.arange(parts)).ravel()
                other = shard != b.column("shard").to_numpy()[i]
                at = pa.array(i[other])
                yield pa.RecordBatch.from_arrays([pa.array(shard[other]), b.column("id").take(at), b.column("v").take(at), b.column("kth").take(at)], ["shard", "id", "v", "kth"])

    away = stage(started.mapInArrow(visits, "shard long, id long, v array<long>, kth double"), "kd-visits")
    found = first.unionByName(_search(candidates, away, k))
    top = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def _search(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best k candidates of the query's shard for each query, scored ``kth`` or more; blocks bound both sides of a group."""
    blocks = stage(queries.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "kd-blocks")
    left = candidates.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = queries.join(blocks, "shard").select(F.col("shard").alias("q_shard"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("q_block"), F.col("id").alias("q_id"), F.col("v").alias("q_v"), "kth")

    def run(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(c) and len(q):
            own = q["q_id"].to_numpy(np.int64)
            for i, ids, scores in search_block(matrix(c["v"]), c["id"].to_numpy(np.int64), matrix(q["q_v"]), own, q["kth"].to_numpy(float), k):
                out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return left.groupBy("shard", "block").cogroup(right.groupBy("q_shard", "q_block")).applyInPandas(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row where ``is_query`` (a condition on the column ``id``) holds."""
    v = F.col(vector_col)
    points = vectors.filter(usable(v) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), quantised(v).alias("v"))
    points = stage(points, "kd-points")
    dims = [r.dim for r in points.select(F.size("v").alias("dim")).distinct().collect()]
    parts = [_search_dimension(points.filter(F.size("v") == d), d, is_query, k, shard_rows) for d in sorted(dims)]
    empty = points.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    out = reduce(DataFrame.unionByName, parts) if parts else empty
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle_sql(k: int = 20, scale: int = SCALE) -> str:
    """DuckDB SQL for the query over ``embeddings``."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
