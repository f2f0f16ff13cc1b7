"""Toxicity: features, held-out accuracy and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import queries, toxicity

BAD = ["loser", "idiot", "moron", "pathetic", "worthless"]


def corpus(n, seed, bad=BAD):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "on", "er", "ti", "and", "re", "hea", "or"]) for _ in range(rng.randint(1, 3)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 80))]
        if i % 3 == 0:
            for _ in range(2):
                words.insert(rng.randint(0, len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*corpus(600, 1))


def score(model, text):
    words = toxicity.words_of(text)
    return toxicity.sigmoid(model.bias + toxicity.best_window(model.word_scores(words))[1])


def test_word_features_share_grams():
    buckets, starts = toxicity.word_features(["idiot", "idiott", "a", "idiot"])
    sets = [set(b.tolist()) for b in np.split(buckets, starts[1:])]
    assert sets[0] == sets[3] and len(sets[0] & sets[1]) >= 8 and not sets[0] & sets[2]
    assert len(sets[2]) == 2  # <a> and itself
    assert (buckets >= 0).all() and (buckets < toxicity.BUCKETS).all()
    assert len(toxicity.word_features(["x"])[0]) == 2 and len(toxicity.word_features([])[0]) == 0


def test_windows_cover_everything():
    for n in range(0, 70):
        starts = toxicity.windows(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))


def test_held_out_accuracy_and_unseen_misspellings(model):
    texts, labels = corpus(300, 9)
    predicted = [int(score(model, t) >= toxicity.THRESHOLD) for t in texts]
    assert np.mean(np.array(predicted) == np.array(labels)) >= 0.98
    misspelt, _ = corpus(300, 11, ["losers", "idiott", "moronn", "patheticc", "worthles"])
    found = [score(model, t) >= toxicity.THRESHOLD for t in misspelt[::3]]
    assert np.mean(found) >= 0.5  # by shared n-grams alone, from a toy vocabulary
    strange, _ = corpus(300, 11, ["qqzzx", "vvkky", "jjwwq"])
    assert np.mean([score(model, t) >= toxicity.THRESHOLD for t in strange[::3]]) <= 0.1
    assert score(model, "") < 0.3 and score(model, None) < 0.3
    assert score(model, " ".join(texts[1:90:3] * 20) + " you idiot loser") >= toxicity.THRESHOLD  # late in a long text


def test_training_is_repeatable_and_one_class_scores_zero(model):
    again = toxicity.train(*corpus(600, 1))
    assert (again.gram == model.gram).all() and again.bias == model.bias
    assert score(toxicity.train(["a", "b"], [0, 0]), "a") < 1e-9


def test_columns_and_odd_rows(model, make_docs, spark):
    rows = [(1, "the hea and"), (2, "you idiot loser"), (2, "you idiot loser"), (3, None), (4, ""), (None, "pathetic moron"), (5, "x"), (6, "the and " * 50_000)]
    docs = make_docs(rows).withColumn("score", F.lit(1)).withColumn("row", F.lit("r"))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6]
    assert toxicity.drop_toxic(docs.filter("doc_id < 0"), model).collect() == []


def test_labels_of_the_held_out_fold_are_never_used(make_docs, spark):
    texts, labels = corpus(240, 3)
    docs = make_docs(list(enumerate(texts)))
    own = [(i, 0, y) for i, y in enumerate(labels)]
    table = spark.createDataFrame(own, "doc_id long, quality int, toxic int")
    sample = {r.id for r in toxicity.labelled_sample(docs, table).collect()}
    assert sample == {i for i in range(240) if zlib.crc32(str(i).encode()) % 3 != 1}
    flipped = spark.createDataFrame([(i, 0, y if i in sample else 1 - y) for i, _, y in own] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    a, b = toxicity.fit(docs, table), toxicity.fit(docs, flipped)
    assert (a.gram == b.gram).all() and a.bias == b.bias
    assert score(toxicity.fit(docs, table.limit(0)), "idiot") < 1e-9


def test_query(spark, sf_dir):
    rows = queries.op3_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_held_out_accuracy_on_the_corpus():
    """Held-out recall and false alarms on the larger table, read without Spark."""
    import pyarrow.parquet as pq

    d = "/root/testdata/sf0.1"
    rows = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pandas().merge(pq.read_table(f"{d}/labels.parquet").to_pandas(), on="doc_id")
    held = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id])
    model = toxicity.train(rows.text[~held].tolist(), rows.toxic[~held].tolist())
    scores = np.array([score(model, t) for t in rows.text[held]])
    y = rows.toxic[held].to_numpy()
    assert (scores[y == 1] >= 0.7).mean() >= 0.7 and (scores[y == 0] >= 0.7).mean() <= 0.015
