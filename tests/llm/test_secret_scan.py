"""Secret scan: candidates, features and held-out accuracy of the forest."""

import random
import re

import pytest
from pyspark.sql import functions as F

from indicata.llm import queries, secret_scan


@pytest.fixture(scope="module")
def corpus(make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["the", "on", "er", "tion", "and", "re", "hea"]) for _ in range(rng.randint(1, 8)))
    rows = []
    for i in range(400):
        words = [word() for _ in range(30)]
        if i % 4 == 0:
            secret = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), "password=" + "".join(rng.choice("0123456789abcdef") for _ in range(18)), 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"'][i // 4 % 3]
            words.insert(rng.randint(0, 30), secret)
        rows.append((i, " ".join(words)))
    return make_docs(rows)


def plain_candidates(text):
    words = re.split(r"\s+", (text or "").strip(" "), flags=re.ASCII)
    return sorted((n, m) for n, w in enumerate(words) for m in re.findall(secret_scan.CORE.replace("\\-", "-"), w) if len(w) >= secret_scan.LEAST)


def test_candidates_against_brute_force(make_docs):
    rows = [(1, None), (2, ""), (3, "  "), (4, "a" * 16), (5, "b" * 15), (6, "x=" + "c" * 20 + "," + "d" * 17 + " end"), (7, "one\n" + "e" * 16 + "\ttwo"), (7, "f" * 200_000), (None, "g" * 16)]
    docs = make_docs(rows)
    got = sorted((r.id is None, r.id or 0, r.place, r.secret) for r in secret_scan.candidates(docs).collect())
    assert got == sorted((i is None, i or 0, n, s) for i, t in rows for n, s in plain_candidates(t))


def test_neighbours(make_docs):
    (r,) = secret_scan.candidates(make_docs([(1, 'my token = "' + "a1" * 10 + '" here')])).collect()
    assert (r.before2, r.before, r.after, r.secret) == ("token", "=", "here", "a1" * 10)


@pytest.mark.parametrize(
    "text,want",
    [
        ("my password=hunter2xyz here", [(1, "hunter2xyz")]),
        ("api_key: 9f86d081884c", [(1, "9f86d081884c")]),
        ("a secret=Tr0ub4dor&3-Zq!x, b", [(1, "Tr0ub4dor&3-Zq!x")]),
        ("token = 'x1'", [(2, "x1")]),
        ('pwd ="ab" and', [(1, "ab")]),
        ('{"password":"p1","token":"t2"}', [(0, "p1"), (0, "t2")]),
        ("?token=ab1&password=cd2", [(0, "ab1"), (0, "cd2")]),
        ('password = "two or three" end', [(2, "two"), (2, "two or three")]),
        ('token = "' + "a1" * 10 + '"', [(2, "a1" * 10)]),
        ("see SG." + "a" * 16 + "." + "b" * 15 + "9 now", [(1, "SG." + "a" * 16 + "." + "b" * 15 + "9"), (1, "a" * 16), (1, "b" * 15 + "9")]),
        ('password=" ab" c', [(1, "ab")]),
        ("password= and nothing, the token", [(1, "and")]),
        ("password=", []),
    ],
)
def test_named_values_of_any_length_and_characters(make_docs, text, want):
    assert sorted((r.place, r.secret) for r in secret_scan.candidates(make_docs([(1, text)], 1)).collect()) == sorted(want)


def test_held_out_accuracy(corpus, spark):
    labelled = spark.range(0, 400).filter("id % 2 = 0").select("id")
    rows = [r for r in secret_scan.scan(corpus, labelled).collect() if r.doc_id % 2]
    truth = {r.doc_id for r in rows if r.rule}
    assert not truth  # secrets stand in documents divisible by four only
    assert not any(r.is_secret for r in rows)
    labelled = spark.range(0, 400).filter("id % 8 <> 0").select("id")
    rows = [r for r in secret_scan.scan(corpus, labelled).collect() if r.doc_id % 8 == 0]
    assert sum(r.rule is not None for r in rows) == 50
    assert sum(r.is_secret == (r.rule is not None) for r in rows) >= 0.98 * len(rows)


def test_formats_absent_from_the_labelled_documents(make_docs, spark):
    rng = random.Random(9)
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    plain = lambda: draw(["the", "tion", "and", "hea"], 6)
    rows = [(i, " ".join([*["the tion and hea"] * 4, plain(), 'token = "' + draw("0123456789abcdef", 40) + '"' if i % 4 == 0 else plain(), plain()])) for i in range(200)]
    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["AKIA" + draw(upper, 16), "ghp_" + draw(mixed, 36), "xoxb-" + draw("abcdefghij", 24), "AIza" + draw(mixed, 35)]
    rows += [(1000 + i, f"the tion {k} and hea") for i, k in enumerate(keys)]
    rows += [(i, "the tion " + draw(mixed + "0123456789", 32) + " and") for i in range(100, 110)]  # unknown runs in labelled documents
    got = secret_scan.scan(make_docs(rows), spark.range(0, 200).select("id")).collect()
    assert {r.secret for r in got if r.is_secret and r.doc_id >= 1000} == set(keys)
    assert not any(r.is_secret for r in got if r.secret.isalpha() and r.secret.islower())


def test_short_and_broken_values_are_judged(make_docs, spark):
    rng = random.Random(12)
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    plain = lambda: draw(["the", "tion", "and", "hea"], 6)
    secret = lambda i: ["password=" + draw("abcdefxyz0123456789", 9) + "7a", "api_key: " + draw("0123456789abcdef", 11) + "1f", "secret=" + draw("ABcd&-!", 12) + "3x"][i % 3]
    docs = make_docs([(i, " ".join(["the tion and hea", plain(), secret(i) if i % 2 else plain(), plain()])) for i in range(240)])
    rows = secret_scan.scan(docs, spark.range(0, 180).select("id")).collect()
    found = {r.doc_id for r in rows if r.is_secret}
    assert set(range(181, 240, 2)) <= found and not any(i % 2 == 0 for i in found)


def test_without_both_labels_the_rule_decides(corpus, spark):
    rows = secret_scan.scan(corpus, spark.range(0).select("id")).collect()
    assert all(r.score == float(r.rule is not None) for r in rows) and sum(r.is_secret for r in rows) == 100


def test_empty_table_missing_path_and_clashing_columns(corpus, spark):
    none = spark.range(0).select("id")
    assert secret_scan.scan(corpus.filter("doc_id < 0"), none).collect() == []
    odd = corpus.drop("source").withColumn("score", F.lit(1)).withColumn("secret", F.lit("s")).withColumn("length", F.lit(2))
    assert secret_scan.scan(odd, none).count() == secret_scan.scan(corpus, none).count()


def test_query_finds_planted_secrets(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op10_secrets(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.place, r.secret) for r in rows) == sorted((i, *c) for i, t in texts.items() for c in plain_candidates(t))
    planted = {(i, m) for i, t in texts.items() for m in re.findall(r"AKIA[0-9A-Z]{16}\b|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}", t or "")}
    assert planted and planted <= {(r.doc_id, r.secret) for r in rows if r.is_secret}


def test_very_long_words(make_docs, spark):
    """A megabyte of what patterns could repeat over: each in seconds, none ends the job."""
    import time

    words = ["aa/" * 350_000, "token" * 200_000, "password=" + ")" * 1_000_000 + "x", "sk-" * 350_000, "-eyJ" * 250_000, "secret=" + "x," * 400_000, "api_key:" + "'" * 500_000, "-" * 1_000_000, "token-" * 170_000 + "=q7Zp"]
    labelled = spark.createDataFrame([(i,) for i in range(len(words))], "id long")
    before = time.time()
    found = {(r.doc_id, len(r.secret)) for r in secret_scan.scan(make_docs(words), labelled).collect()}
    assert time.time() - before < 120
    assert {(0, 1_050_000), (1, 1_000_000), (8, 4)} <= found
