"""Spelling variants through a dictionary of trie-node pairs.

1. The words of all texts are counted (map-side partial counts, so a word that
   a third of all texts share arrives as one row a task).
2. Two tries number the words' beginnings and ends. The words are sorted over
   range partitions; a word opens as many new nodes as it is longer than its
   common beginning with the word before it, so a task numbers its part of the
   trie in one pass and holds one word. The first words of a partition may
   continue nodes of the partition before it: ``aliases`` gives those nodes
   their first number, from one small row per partition. The reversed words
   give the second trie.
3. Every place of a word is a pair (node of what stands before it, node of
   what stands after it): with its character skipped, or, between two
   characters, with nothing skipped. Words that differ by a replaced character
   share a skipped pair; a word without one character of another shares its
   unskipped pair with the other's skipped one. Node numbers name beginnings
   and ends one to one, so joining on the two integers finds exactly the
   words at distance one, and every such pair of words once: of a run of equal
   characters, only the last one counts as left out.

A pair's group holds at most one word for each character of the alphabet and
one unskipped word; each member gets its count and best neighbour from the
group as a whole, so no pairs of words are written. A word's number of rows is
twice its length, also for very long words.

Defined results: null texts have no words; a null id counts as the empty text
in the key that chooses the damaged runs. Words shorter than ``LEAST_LETTERS``
or rarer than ``LEAST_COUNT`` take no part. Repeated rows count each time;
extra columns are not read. Of equally frequent neighbours the first in
code-point order is the form. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicata.llm.common import crc32_sql, shuffle_partitions, stage, text_or_empty

LETTERS = "A-Za-z\\u00C0-\\u00FF"
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
RATIO = 10
#: One of so many runs is damaged.
DAMAGED = 31
#: Nodes of a partition, and words of a partition, are numbered below these.
NODE_BITS = 40
WORD_BITS = 33
#: Words whose pairs a Python worker builds at a time.
SLICE = 2_000

GAP, SKIP, LAST_SKIP = 0, 1, 2


def lower_ascii(run: Column) -> Column:
    """Only A-Z lower-cased; text of ASCII alone takes the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, upper, upper.lower()))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """(id, run): every maximal run of letters of at least ``least``, A-Z lower-cased."""
    found = F.regexp_extract_all(text_or_empty(F.col(f"`{text_col}`")), F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(found).alias("run")).select("id", lower_ascii(F.col("run")).alias("run"))


def damaged(found: DataFrame) -> Column:
    """The run, without one code point where the checksum of id and run says so."""
    code = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    place = (code % F.length("run")).cast("int")
    without = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    return F.when(code % DAMAGED == 0, without).otherwise(F.col("run"))


def vocabulary(words: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words (column ``word``) that are long and frequent enough."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def common(a: str, b: str) -> int:
    """Length of the common beginning; by halving, so that long words cost no loop over characters."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _number_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys to (part, id, key, n, nodes): ``nodes[k]`` is the node of the first k characters (0: the root)."""
    part = TaskContext.get().partitionId()
    base, order, last, stack, fresh = part << NODE_BITS, part << WORD_BITS, "", np.zeros(1, np.int64), 0
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            cut = b.slice(k, SLICE)
            keys, lists = cut.column("key").to_pylist(), []
            for key in keys:
                kept = common(last, key) + 1 if fresh else 1
                new = len(key) + 1 - kept
                stack = np.concatenate([stack[:kept], np.arange(base + fresh + 1, base + fresh + new + 1)])
                fresh, last = fresh + new, key
                lists.append(stack)
            ids = cut.column("id") if "id" in cut.schema.names else pa.array(range(order, order + len(keys)), pa.int64())
            order += len(keys)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(keys), pa.int32()), ids, cut.column("key"), cut.column("n"), nodes], ["part", "id", "key", "n", "nodes"])


NUMBERED = "part int, id long, key string, n long, nodes array<long>"


def trie(keys: DataFrame, name: str) -> DataFrame:
    """Number the trie nodes of the distinct keys (``key``, ``n`` and, if it is there, ``id``), written.

    Ids, where they are made here, grow in code-point order of the keys.
    """
    parts = shuffle_partitions(keys.sparkSession)
    ordered = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return stage(ordered.mapInArrow(_number_nodes, NUMBERED), name)


def aliases(numbered: DataFrame) -> DataFrame:
    """(part, alias): ``alias[k]`` is the first number of the node that a partition numbered k-th, as far as it continues the partition before it.

    One row per partition passes through one task, which holds two words.
    """
    ends = numbered.groupBy("part").agg(F.min("key").alias("first"), F.max_by(F.struct("key", "nodes"), "key").alias("last"))
    ends = ends.select("part", "first", F.col("last.key").alias("last"), F.col("last.nodes").alias("nodes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, nodes = "", np.zeros(1, np.int64)
        for b in batches:
            for row in b.to_pylist():
                alias = nodes[: common(word, row["first"]) + 1]
                word, nodes = row["last"], renumber(np.array(row["nodes"], np.int64), row["part"], alias)
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([alias], pa.list_(pa.int64()))], ["part", "alias"])

    return stage(ends.repartition(1).sortWithinPartitions("part").mapInArrow(run, "part int, alias array<long>"), "spelling-aliases")


def renumber(nodes: np.ndarray, part: int, alias: np.ndarray) -> np.ndarray:
    """Nodes with those of ``part`` that have an alias replaced by it."""
    local = nodes - (part << NODE_BITS)
    known = (local > 0) & (local < len(alias))
    return np.where(known, alias[np.where(known, local, 0)], nodes)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _global(part: pa.Array, nodes: pa.ListArray, alias: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat nodes of a batch under their first numbers, and the lists' lengths."""
    flat, sizes = _flat(nodes)
    parts = part.to_numpy()
    for p, at in zip(*np.unique(parts, return_index=True)):
        flat = renumber(flat, int(p), alias[int(at)].values.to_numpy())
    return flat, sizes


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            cut = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in b.slice(k, SLICE).columns], b.schema.names)
            before, sizes = _global(cut.column("part"), cut.column("nodes"), cut.column("alias"))
            after, _ = _global(cut.column("end_part"), cut.column("end_nodes"), cut.column("end_alias"))
            stops = np.cumsum(sizes)
            starts = stops - sizes
            # The end's node k covers the last k characters: turned round, entry i covers all from i on.
            after = after[np.repeat(stops - 1 + starts, sizes) - np.arange(len(after))]
            letters = np.frombuffer("".join(cut.column("key").to_pylist()).encode("utf-32-le"), "<u4")
            no_last, no_first = np.ones(len(before), bool), np.ones(len(before), bool)
            no_last[stops - 1], no_first[starts] = False, False
            word_stops = np.cumsum(sizes - 1) - 1
            run_end = np.append(letters[1:] != letters[:-1], True)
            run_end[word_stops] = True
            ids, n = (np.repeat(cut.column(c).to_numpy(), sizes) for c in ("id", "n"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([before, before[no_last]])),
                    pa.array(np.concatenate([after, after[no_first]])),
                    pa.array(np.concatenate([np.full(len(before), GAP, np.int8), np.where(run_end, LAST_SKIP, SKIP).astype(np.int8)])),
                    pa.array(np.concatenate([ids, ids[no_last]])),
                    pa.array(np.concatenate([n, n[no_last]])),
                ],
                ["before", "after", "kind", "id", "n"],
            )


def pairs(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """(before, after, kind, id, n): the node pairs of every word, from the numbered tries of the words and of the reversed words."""
    a = starts.join(aliases(starts), "part").select("id", "n", "key", "part", "nodes", "alias")
    e = ends.join(aliases(ends), "part").select("id", F.col("part").alias("end_part"), F.col("nodes").alias("end_nodes"), F.col("alias").alias("end_alias"))
    return a.join(e, "id").mapInArrow(_pairs, "before long, after long, kind byte, id long, n long")


def neighbours(node_pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): number of words at distance one, and the most frequent of them as (less = -n, id)."""
    place = Window.partitionBy("before", "after")
    shared = node_pairs.withColumn("rows", F.count(F.lit(1)).over(place)).withColumn("skips", F.sum((F.col("kind") != GAP).cast("int")).over(place))
    member = F.struct((-F.col("n")).alias("less"), "id", (F.col("kind") == LAST_SKIP).alias("left_out"))
    # At most a word for each letter of the alphabet, and one without a skip.
    group = shared.filter("rows > 1 AND skips > 0").groupBy("before", "after").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") != GAP, member))).alias("skipped"),
        F.max(F.when(F.col("kind") == GAP, F.struct((-F.col("n")).alias("less"), "id"))).alias("whole"),
    )
    group = group.withColumn("shorter", F.filter("skipped", lambda e: e["left_out"]))
    word = lambda e: F.struct(e["less"].alias("less"), e["id"].alias("id"))

    def of_skipped(e: Column) -> Column:
        first, second = F.get("skipped", F.lit(0)), F.get("skipped", F.lit(1))
        other = F.when(first["id"] == e["id"], word(second)).otherwise(word(first))
        other = F.when(F.size("skipped") > 1, other)
        pair = e["left_out"] & F.col("whole").isNotNull()
        return F.struct(
            e["id"].alias("id"),
            (F.size("skipped") - 1 + pair.cast("int")).alias("near"),
            F.array_min(F.array_compact(F.array(other, F.when(pair, F.col("whole"))))).alias("best"),
        )

    of_whole = F.struct(F.col("whole.id").alias("id"), F.size("shorter").alias("near"), word(F.get("shorter", F.lit(0))).alias("best"))
    parts = F.concat(F.transform("skipped", of_skipped), F.when(F.col("whole").isNotNull() & (F.size("shorter") > 0), F.array(of_whole)).otherwise(F.array().cast("array<struct<id:bigint,near:int,best:struct<less:bigint,id:bigint>>>")))
    part = group.select(F.explode(parts).alias("p")).select("p.*").filter("near > 0")
    return part.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def follow(edges: DataFrame, steps: int) -> DataFrame:
    """(id, root): the last node of every chain of (id, form), whose chains have at most ``steps`` edges, by doubling."""
    roots = edges.select("id", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("onward"))
        roots = roots.join(onward, "root", "left").select("id", F.coalesce("onward", "root").alias("root"))
    return roots


def group_variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for (word, n) with distinct words."""
    words = trie(counted.select(F.col("word").alias("key"), "n"), "spelling-starts")
    ends = trie(words.select(F.reverse("key").alias("key"), "id", "n"), "spelling-ends")
    near = stage(neighbours(pairs(words, ends)), "spelling-near")
    light = words.select("id", "n", F.col("key").alias("word"))
    best = light.join(near, "id", "left").withColumn("form_n", -F.col("best.less"))
    best = best.withColumn("form", F.when(F.col("form_n") >= F.col("n") * ratio, F.col("best.id")))
    best = stage(best.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n")), "spelling-best")
    # Every step multiplies the count, which bounds the chains.
    top = best.agg(F.max("n")).first()[0] or 1
    steps, reach = 0, 1
    while reach * ratio <= top:
        steps, reach = steps + 1, reach * ratio
    roots = follow(best.filter("form IS NOT NULL").select("id", "form"), steps)
    texts = best.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    named = best.filter("form IS NOT NULL").join(roots, "id").join(texts, "form", "left")
    named = named.join(texts.select(F.col("form").alias("root"), F.col("form_word").alias("root_word")), "root", "left")
    out = best.filter("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return out.unionByName(named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of ``docs``, some runs damaged as ``damaged`` says, with their forms."""
    found = runs(docs, id_col, text_col)
    return group_variants(stage(vocabulary(found.select(damaged(found).alias("word"))), "spelling-words"))


def oracle_sql() -> str:
    """``variants`` of the table ``documents`` as DuckDB SQL: neighbours share their text around a place that is left out."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE runs AS (
  SELECT r, coalesce(doc_id::VARCHAR, '') || ':' || r AS s
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')), '{upper}', '{upper.lower()}') AS r FROM documents) WHERE length(r) >= {LEAST_LETTERS}
),{crc32_sql("SELECT s FROM runs", "sums")},
v AS (
  SELECT CASE WHEN crc % {DAMAGED} = 0 THEN left(r, (crc % length(r))::INT) || substr(r, (crc % length(r))::INT + 2) ELSE r END AS w, count(*) AS n FROM runs JOIN sums USING (s)
  GROUP BY 1 HAVING count(*) >= {LEAST_COUNT} AND length(w) >= {LEAST_LETTERS}
), skipped AS (SELECT w, left(w, i::INT) AS p, substr(w, i::INT + 2) AS e FROM (SELECT w, unnest(range(length(w))) AS i FROM v)),
whole AS (SELECT w, left(w, i::INT) AS p, substr(w, i::INT + 1) AS e FROM (SELECT w, unnest(range(length(w) + 1)) AS i FROM v)),
near AS (
  SELECT a.w AS x, b.w AS y FROM skipped a JOIN skipped b ON a.p = b.p AND a.e = b.e AND a.w <> b.w
  UNION SELECT a.w, b.w FROM skipped a JOIN whole b ON a.p = b.p AND a.e = b.e
  UNION SELECT b.w, a.w FROM skipped a JOIN whole b ON a.p = b.p AND a.e = b.e
), best AS (
  SELECT x, y, v.n AS m, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) AS k FROM near JOIN v ON v.w = y
), forms AS (
  SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * n THEN y END AS form, CASE WHEN m >= {RATIO} * n THEN m END AS form_n FROM v LEFT JOIN best ON x = w AND k = 1
), chain AS (
  SELECT w, w AS at FROM forms UNION ALL SELECT c.w, f.form FROM chain c JOIN forms f ON f.w = c.at WHERE f.form IS NOT NULL
), roots AS (SELECT c.w, c.at AS root FROM chain c JOIN forms f ON f.w = c.at WHERE f.form IS NULL)
SELECT w AS word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN roots USING (w)"""
