"""Mixing: posteriors, fitted totals and copies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import mixing, queries

WORDS = {"en": "the of and to in is that was".split(), "de": "der die und in zu den das von".split(), "fr": "le la et les des un une est".split()}
TARGETS = {"en": 0.5, "de": 0.3, "fr": 0.2}


@pytest.fixture(scope="module")
def corpus(make_docs):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        lang = "en" if i % 3 else ("de" if i % 2 else "fr")
        rows.append((i, " ".join(rng.choice(WORDS[lang] + ["noise"]) for _ in range(rng.randint(20, 60))), lang))
    rows += [(1000, None, "en"), (1001, "", None), (None, "the of and", None), (1002, "der die und das", None)]
    return make_docs(rows)


@pytest.fixture(scope="module")
def trusted(spark):
    return spark.range(0, 200).select(F.col("id"))


def numpy_rates(t, p, goal, least, start, iterations=200):
    """The same descent in numpy."""
    r = np.full(len(t), start)
    scale = np.maximum(goal, 1e-3 * goal.sum())
    h = (p * t[:, None]).T @ p
    step = 1 / np.linalg.eigvalsh(h / np.sqrt(np.outer(scale, scale))).max()
    for _ in range(iterations):
        e = ((r * t) @ p - goal) / scale
        r = np.maximum(least, r - step * p @ e)
    return r


def test_posteriors_tell_languages(corpus, trusted):
    rows = mixing.mix(corpus, F.col("lang"), trusted, TARGETS).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        p = {d: r[f"p_{d}"] for d in TARGETS}
        assert abs(sum(p.values()) - 1) < 1e-9
        if r.doc_id < 300:
            assert max(p, key=p.get) == r.lang
        if r.doc_id == 1002:
            assert max(p, key=p.get) == "de"


@pytest.mark.parametrize("least,total", [(0.0, None), (1.0, None), (0.0, 500.0), (0.4, 30_000.0)])
def test_totals_meet_the_targets_or_their_projection(corpus, trusted, least, total):
    rows = mixing.mix(corpus, F.col("lang"), trusted, TARGETS, total=total, least=least).collect()
    t = np.array([r.tokens for r in rows], float)
    p = np.array([[r[f"p_{d}"] for d in TARGETS] for r in rows])
    r = np.array([x.rate for x in rows])
    assert (r >= least - 1e-12).all()
    reached = (r * t) @ p
    want = np.array(list(TARGETS.values()))
    assert np.abs(reached / reached.sum() - want).max() < 1e-3
    if total:
        assert abs(reached.sum() - total) < 1e-3 * total


def test_a_binding_projection_equals_numpy(corpus, trusted, spark):
    members, domains = mixing.memberships(corpus, F.col("lang"), trusted, TARGETS)
    fitted, history = mixing.fit_rates(members, [0.02, 0.96, 0.02], 2_000.0, least=0.1, iterations=200)
    rows = fitted.collect()
    t, p = np.array([x.tokens for x in rows], float), np.array([[x[f"p_{i}"] for i in range(3)] for x in rows])
    want = numpy_rates(t, p, 2_000.0 * np.array([0.02, 0.96, 0.02]), 0.1, max(0.1, 2_000.0 / t.sum()))
    got = np.array([x.rate for x in rows])
    assert np.abs((got * t) @ p - (want * t) @ p).max() < 1e-3 and (got >= 0.1).all()


def one_domain_rows(spark, shares, n=2_000, soft=0.02):
    """Members whose posteriors lean to one domain; ``shares`` of the tokens lie in each domain."""
    rng, k, rows = np.random.default_rng(5), len(shares), []
    for d, share in enumerate(shares):
        for _ in range(round(n * share)):
            other = rng.dirichlet(np.ones(k)) * soft * rng.random()
            p = other + (1 - other.sum()) * np.eye(k)[d]
            rows.append((len(rows), 40, *map(float, p)))
    return spark.createDataFrame(rows, "id long, tokens long, " + ", ".join(f"p_{i} double" for i in range(k)))


@pytest.mark.parametrize("shares", [(0.01, 0.79, 0.1, 0.1), (0.90, 0.06, 0.02, 0.02)])
def test_rare_and_hot_domains_reach_their_targets(spark, stored, shares):
    members, w = stored(one_domain_rows(spark, shares).coalesce(2)), np.array(list(mixing.TARGETS.values()))
    total = 40.0 * members.count()
    rated, history = mixing.fit_rates(members, list(w), total)
    rows = rated.collect()
    reached = np.array([sum(r.rate * r.tokens * r[f"p_{i}"] for r in rows) for i in range(4)])
    assert np.abs(reached - w * total).max() < 1e-5 * total and min(r.rate for r in rows) >= 0
    assert len(history) < 6
    # every row kept: the shares are those of the targets as far as soft memberships allow
    rows = mixing.fit_rates(members, list(w), None, least=1.0)[0].collect()
    reached = np.array([sum(r.rate * r.tokens * r[f"p_{i}"] for r in rows) for i in range(4)])
    assert np.abs(reached / reached.sum() - w).max() < 2e-3 and min(r.rate for r in rows) >= 1


def test_a_binding_bound_is_solved(spark, stored):
    members = stored(one_domain_rows(spark, (0.3, 0.4, 0.3)).coalesce(2))
    goal, least = 20_000.0 * np.array([0.02, 0.96, 0.02]), 0.4
    rows = mixing.fit_rates(members, [0.02, 0.96, 0.02], 20_000.0, least=least)[0].collect()
    t, p = np.array([r.tokens for r in rows], float), np.array([[r[f"p_{i}"] for i in range(3)] for r in rows])
    loss = lambda x: (((x * t) @ p - goal) ** 2 / goal).sum() / 2
    got, want = np.array([r.rate for r in rows]), numpy_rates(t, p, goal, least, least, 20_000)
    assert (got >= least).all() and loss(got) <= loss(want) * (1 + 1e-6)


@pytest.mark.parametrize("shares,soft", [((0.9, 0.06, 0.02, 0.02), 0.3), ((0.25, 0.25, 0.25, 0.25), 0.6)])
def test_targets_are_met_although_every_row_stays(spark, stored, shares, soft):
    """Soft members feed full domains too; the total makes room for that."""
    members, w = stored(one_domain_rows(spark, shares, soft=soft).coalesce(2)), np.array(list(mixing.TARGETS.values()))
    rated, history = mixing.fit_rates(members, list(w), None, least=1.0)
    rows = rated.collect()
    reached = np.array([sum(r.rate * r.tokens * r[f"p_{i}"] for r in rows) for i in range(4)])
    assert np.abs(reached / (w * reached.sum()) - 1).max() < 1e-5 and min(r.rate for r in rows) >= 1
    assert len(history) < 16


def test_reachable_total():
    w, now = np.array([0.5, 0.5]), np.array([90.0, 10.0])
    pure = np.array([[90.0, 0.0], [0.0, 10.0]])
    assert mixing.reachable_total(w, now, pure, 1.0) == pytest.approx(180.0)
    # Repeats of the second group bring a fifth of their tokens to the first domain: 90 + 0.2 x = 10 + 0.8 x
    soft, now = np.array([[88.0, 0.0], [2.0, 8.0]]), np.array([90.0, 8.0])
    x = (90.0 - 8.0) / 0.6
    assert mixing.reachable_total(w, now, soft, 1.0) == pytest.approx(98.0 + x)
    # Groups that do not tell the domains apart, and an empty one: no target below what there is.
    for groups in (np.array([[45.0, 5.0], [45.0, 5.0]]), np.array([[90.0, 10.0], [0.0, 0.0]])):
        assert mixing.reachable_total(w, np.array([90.0, 10.0]), groups, 1.0) == pytest.approx(180.0)


def test_a_fit_that_does_not_converge_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LIMIT", 2)
    with pytest.raises(RuntimeError, match="not converged"):
        mixing.fit_rates(one_domain_rows(spark, (0.3, 0.4, 0.3)), [0.02, 0.96, 0.02], 20_000.0, least=0.4)


def test_copies(spark):
    df = spark.range(4_000).withColumn("rate", F.lit(1.25))
    n = [r[0] for r in df.select(mixing.copies(F.col("rate"), F.col("id").cast("string"))).collect()]
    assert set(n) == {1, 2} and abs(np.mean(n) - 1.25) < 0.03


def test_resample_keeps_every_document_and_repeats_rare_domains(corpus, trusted):
    decided = {(r.doc_id, r.text_key): r.copies for r in mixing.mix(corpus, F.col("lang"), trusted, TARGETS, least=1.0).collect()}
    out = mixing.resample(corpus, F.col("lang"), trusted, TARGETS)
    assert out.columns == corpus.columns
    counts = {}
    for r in out.select("doc_id").collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for (i, _), n in decided.items()}
    assert min(counts.values()) == 1 and sum(counts.values()) > corpus.count()


def test_without_labels_or_rows(corpus, trusted, spark):
    none = mixing.mix(corpus, F.col("lang"), spark.range(0).select("id"), TARGETS)
    assert {r.rate for r in none.collect()} == {1.0}
    empty = corpus.filter("doc_id < 0")
    assert mixing.mix(empty, F.col("lang"), trusted, TARGETS).collect() == []
    assert mixing.resample(empty, F.col("lang"), trusted, TARGETS).collect() == []


def test_clashing_columns(corpus, trusted):
    odd = corpus.withColumn("rate", F.lit(3)).withColumn("copies", F.lit(4)).withColumn("p_0", F.lit(5)).withColumn("tokens", F.lit(6))
    assert mixing.resample(odd, F.col("lang"), trusted, TARGETS).select("rate", "copies", "p_0", "tokens").distinct().collect() == [(3, 4, 5, 6)]


def test_query_meets_its_targets(spark, sf_dir):
    rows = queries.op9_mixing(spark, sf_dir).collect()
    t = np.array([r.tokens for r in rows], float)
    reached = np.array([sum(r.rate * r.tokens * r[f"p_{d}"] for r in rows) for d in mixing.TARGETS])
    assert np.abs(reached / t.sum() - np.array(list(mixing.TARGETS.values()))).max() < 1e-3
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_no_python_in_the_plan(corpus, trusted):
    plan = mixing.mix(corpus, F.col("lang"), trusted, TARGETS)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
