"""Spelling variants: the query and the trie-node pairs against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from indicata.llm import spelling


def counted(docs):
    """Words and counts of (id, text), with the damage, in plain Python."""
    c = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    lengths = {}
    for w in counts:
        lengths.setdefault(len(w), []).append(w)
    others = {w: [x for k in (-1, 0, 1) for x in lengths.get(len(w) + k, ()) if near(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(others[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(others[w]), None if form[w] is None else counts[form[w]]) for w, n in counts.items()}


def rows_of(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force_and_sql(spark, sf_dir, duck_docs):
    from indicata.llm import queries

    sql = duck_docs.sql(queries.ORACLE_SQL["op12_spelling"])
    assert sorted(sql.columns) == sorted(queries.op12_spelling(spark, sf_dir).columns)
    assert {tuple(dict(zip(sql.columns, r))[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in sql.fetchall()} == rows_of(queries.op12_spelling(spark, sf_dir))
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op12_spelling(spark, sf_dir)) == brute(counted(docs))


@pytest.mark.parametrize("letters, length, partitions", [("ab", 7, 8), ("aé", 8, 3), ("abcdefghijklmnopqrstuvwxyzÀß", 1, 5)])
def test_dense_words(spark, letters, length, partitions):
    """Words that are nearly all neighbours of each other, whose tries run over every partition boundary."""
    r = random.Random(length)
    stem = "prefixed" * 3 if length == 1 else ""
    words = {stem + "".join(r.choice(letters) for _ in range(length + r.randrange(2))) for _ in range(400)}
    counts = {w: r.choice([2, 3, 30, 30, 500]) for w in words}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = rows_of(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(counts)


def test_chains_ties_and_very_long_words(spark):
    long = "lengthy" * 20_000
    counts = {
        "chaining": 3, "chainings": 40, "chainingss": 500, "chainingsss": 50_000, "chainingssss": 700_000,  # four steps
        "tiesabc": 2, "tiesabd": 90, "tiesabb": 90, "tiesabé": 90,
        "balloons": 10, "baloons": 1, "ballloons": 100, "balllloons": 99,
        long: 5, long[:70_000] + long[70_001:]: 70, long + "s": 4,
    }
    assert rows_of(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_odd_texts(spark):
    docs = [
        (None, "Exception ÉXCEPTION exception"), (1, None), (2, ""), (3, "exception " * 40), (3, "exception " * 40), (4, "exceptio1n exceptiőon EXCEPTION÷×exception"),
        (5, " ".join(f"{a}xception" for a in "abcdefghijklmnopqrstuvwxyz") * 2), (6, "q" * 300_000 + " " + "q" * 300_000), (7, "exceptions exceptions"), *[(100 + i, "Elephants elefants Elephants") for i in range(60)],
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS word", "2 AS n", "3 AS run")
    assert rows_of(spelling.variants(df)) == brute(counted(docs))
    assert rows_of(spelling.variants(df.limit(0))) == set()


def test_a_hot_word(spark):
    docs = [(i, "hotword " * 40 + f"rareword{'abcdefghij'[i % 10]} " * 3) for i in range(300)]
    assert rows_of(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))) == brute(counted(docs))


def test_no_pairs_within_a_group(spark):
    """All words of a group at distance one of each other: rows stay in proportion to words and their length."""
    words = spark.createDataFrame([("abcdefg" + c, 2) for c in "abcdefghijklmnopqrstuvwxyz"], "word string, n long")
    tries = spelling.trie(words.selectExpr("word AS key", "n"), "t")
    pairs = spelling.pairs(tries, spelling.trie(tries.selectExpr("reverse(key) AS key", "id", "n"), "e"))
    assert pairs.count() == 26 * (2 * 8 + 1)
    near_rows = spelling.neighbours(pairs)
    assert {r.n_near for r in near_rows.collect()} == {25}
