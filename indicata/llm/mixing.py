"""Mixing documents to target domain weights by soft membership (DataFrame functions only).

1. Classifier. From labelled documents the most telling words of each domain
   are learned (smoothed log-odds of document frequency), and a multinomial
   model of how often each domain's documents use each domain's words. A text's
   posterior over domains follows from its own word counts.
2. Rates. Every document d gets a rate r_d >= ``least``: how often it is to
   appear. With t_d tokens and posteriors p_dk the expected tokens of domain k
   are m_k = sum(r_d t_d p_dk). Projected gradient descent on
   sum((m_k - T_k)^2 / T_k) / 2, scaled by the domain matrix: with
   H = sum(t_d p_d p_d') over the rates that are not held, a round moves every
   such rate by -p_d . (H + damping diag(T))^-1 (m - T) and projects it on
   r >= ``least``. Held are the rates at ``least`` that the gradient would lower
   further. A round is accepted if the sum falls by a tenth of what the gradient
   promises for it; if not, the damping grows, until the step is a short plain
   gradient step. Matrix and totals are one aggregation over all documents each;
   only domain sums reach the driver. Rounds go on until the totals are within
   ``TOLERANCE`` of the targets or, where the bound binds, a round lowers the sum
   by less than ``STILL`` of it; if ``LIMIT`` aggregations do not suffice, the
   fit raises. Without a given total, targets are made large enough to be met at
   rates of ``least`` or more by raising each domain's documents evenly.
3. Copies. A document appears floor(r) times and once more with the
   probability of the rest, drawn by a hash of its id and text.

The word lists are learned on a bounded sample: at most ``SAMPLE`` labelled
documents of each domain by hash order. Everything else covers all documents.

Defined results: null text has no tokens and the prior as posterior. Documents
with a null label or a null id are scored but not learned from. Domains
without labelled documents or without a target are left out and the targets
rescaled; with no domain left every rate is 1. Repeated rows get the same rate
and copies. An empty table gives an empty result. Extra columns pass through
``resample``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import stage, text_or_empty

#: Target share of tokens of each domain (language) in the mix.
TARGETS = {"de": 0.15, "en": 0.6, "es": 0.1, "fr": 0.15}
LEXICON = 48
SAMPLE = 2_000
WRITE_EVERY = 4
TOLERANCE = 1e-6
#: Aggregations after which a fit that has not converged raises (3 to 20 are usual, up to 250 where the bound binds).
LIMIT = 400
#: Share of the sum of squares by which a round must lower it where the targets cannot be met.
STILL = 1e-7
#: Least damping, and the one beyond which no step descends.
DAMPING, DAMPING_MOST = 1e-12, 1e6



def words(text: Column) -> Column:
    """Lower-case words at white space."""
    return F.filter(F.split(F.lower(text), "\\s+"), lambda w: w != "")


def learn_lexicons(some: DataFrame, domains: Sequence[str], size: int = LEXICON) -> dict[str, list[str]]:
    """Most telling words of each domain, from a bounded sample of (text, domain) rows; at most domains x size words reach the driver."""
    seen = some.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    per_word = seen.groupBy("word").pivot("domain", list(domains)).count().na.fill(0)
    n = {r.domain: r["count"] for r in some.groupBy("domain").count().collect()}
    out: dict[str, list[str]] = {}
    for d in domains:
        rest = sum((F.col(f"`{o}`") for o in domains if o != d), F.lit(0))
        n_rest = sum(n.get(o, 0) for o in domains if o != d)
        inside, outside = (F.col(f"`{d}`") + 0.5) / (n.get(d, 0) + 1), (rest + 0.5) / (n_rest + 1)
        # telling and frequent: log-odds weighted by how many documents use the word
        rows = per_word.select("word", (inside * F.log(inside / outside)).alias("gain")).filter("gain > 0").orderBy(F.col("gain").desc(), "word").limit(size).collect()
        out[d] = [r.word for r in rows]
    return out


def _hits(found: Column, lexicons: dict[str, list[str]]) -> list[Column]:
    distinct = F.array_distinct(found)
    return [F.size(F.array_intersect(distinct, F.array(*[F.lit(w) for w in ws]).cast("array<string>"))).alias(f"hits_{k}") for k, ws in enumerate(lexicons.values())]


def posteriors(hits: Sequence[Column], prior: np.ndarray, share: np.ndarray) -> list[Column]:
    """Softmax of log prior + sum of hits x log share (share[c, k]: domain c's hits that fall in lexicon k)."""
    scores = [sum((h * float(math.log(share[c, k])) for k, h in enumerate(hits)), F.lit(float(math.log(prior[c])))) for c in range(len(prior))]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def memberships(docs: DataFrame, domain: Column, trusted: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """((id, text_key, tokens, p_0 ...), domains): token count and posterior of every row.

    ``domain`` is a column of ``docs``; only rows whose id is in ``trusted`` (column ``id``) teach.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), domain.alias("domain"))
    # Without text: only ids and domains are shuffled to find the labelled rows.
    labelled = stage(rows.select("id", "domain").join(trusted.select("id").distinct(), "id", "left_semi").filter(F.col("domain").isin(list(targets))), "mix-labelled")
    counted = {r.domain: r["count"] for r in labelled.groupBy("domain").count().collect()}
    domains = [d for d in targets if counted.get(d)]
    if not domains:
        return stage(rows.select("id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("tokens")), "mix-docs"), []
    picked = [labelled.filter(F.col("domain") == d).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for d in domains]
    ids = reduce(DataFrame.unionByName, picked).select("id", "domain").distinct()
    sample = stage(rows.join(F.broadcast(ids), ["id", "domain"], "left_semi").select("text", "domain"), "mix-sample")  # domains x SAMPLE ids at most
    lexicons = learn_lexicons(sample, domains)
    features = rows.select("id", "domain", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words")).select("id", "domain", "text_key", F.size("words").cast("long").alias("tokens"), *_hits(F.col("words"), lexicons))
    features = stage(features, "mix-features")
    hits = [f"hits_{k}" for k in range(len(domains))]
    taught = features.join(trusted.select("id").distinct(), "id", "left_semi").groupBy("domain").agg(*[F.sum(h).alias(h) for h in hits]).filter(F.col("domain").isin(domains)).collect()
    sums = {r.domain: np.array([r[h] for h in hits], float) for r in taught}
    share = np.array([(sums[d] + 1) / (sums[d] + 1).sum() for d in domains])
    prior = np.array([counted[d] for d in domains], float)
    p = posteriors([F.col(h) for h in hits], prior / prior.sum(), share)
    return stage(features.select("id", "text_key", "tokens", *[c.alias(f"p_{k}") for k, c in enumerate(p)]), "mix-docs"), domains


def fit_rates(members: DataFrame, weights: Sequence[float], total: float | None = None, least: float = 0.0, iterations: int | None = None) -> tuple[DataFrame, list[dict[str, list[float]]]]:
    """(members with ``rate``, history of expected and target domain totals).

    ``total``: tokens of the mix; None: see ``reachable_total``, or with ``least``
    of 0 as many as make no target smaller than what the domain has at rate 1.
    ``iterations``: None iterates until converged; a number makes that many
    plain gradient steps, converged or not.
    """
    k = len(weights)
    p = [F.col(f"p_{i}") for i in range(k)]
    t = F.col("tokens").cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    likeliest = F.array_position(F.array(*p), F.greatest(*p) if k > 1 else p[0]) - 1
    groups = [F.sum(F.when(likeliest == g, t * p[i])).alias(f"g_{g}_{i}") for g in range(k) for i in range(k)]
    row = members.agg(*[F.sum(t * p[i]).alias(f"m_{i}") for i in range(k)], *[F.sum(t * p[i] * p[j]).alias(f"h_{i}_{j}") for i, j in pairs], *groups).first()
    now = np.array([row[f"m_{i}"] or 0.0 for i in range(k)])
    w = np.array(weights, float) / sum(weights)
    if not now.sum():
        return members.withColumn("rate", F.lit(float(max(1.0, least)))), []
    if total is None:
        total_tokens = reachable_total(w, now * max(least, 1.0), np.array([[row[f"g_{g}_{i}"] or 0.0 for i in range(k)] for g in range(k)]), least)
    else:
        total_tokens = float(total)
    goal = w * total_tokens
    scale = np.maximum(goal, 1e-3 * goal.sum())
    start = max(least, float(goal.sum() / now.sum()) if total is not None else max(least, 1.0))
    if iterations is None:
        return _descend(members.withColumn("rate", F.lit(start)), start * now, goal, scale, float(least))
    h = np.zeros((k, k))
    for i, j in pairs:
        h[i, j] = h[j, i] = row[f"h_{i}_{j}"] or 0.0
    root = 1 / np.sqrt(scale)
    step = 1 / float(np.linalg.eigvalsh(root[:, None] * h * root[None, :]).max())
    rated = members.withColumn("rate", F.lit(start))
    rate: Column = F.col("rate")
    history = []
    for n in range(iterations):
        if n and n % WRITE_EVERY == 0:  # the rates so far, so that no expression grows with the iterations
            rated = stage(rated.withColumn("rate", rate), "mix-rates")
            rate = F.col("rate")
        sums = rated.agg(*[F.sum(rate * t * c).alias(f"m_{i}") for i, c in enumerate(p)]).first()
        reached = np.array([sums[f"m_{i}"] or 0.0 for i in range(k)])
        history.append({"expected": reached.tolist(), "target": goal.tolist()})
        error = (reached - goal) / scale
        if np.abs(error).max() < TOLERANCE:
            break
        move = sum((c * float(step * error[i]) for i, c in enumerate(p)), F.lit(0.0))
        rate = F.greatest(F.lit(float(least)), rate - move)
    return rated.withColumn("rate", rate), history


def reachable_total(w: np.ndarray, now: np.ndarray, groups: np.ndarray, least: float) -> float:
    """Tokens of a mix that keeps ``now`` and meets the shares ``w``.

    ``groups[g, i]``: tokens of domain i in documents whose likeliest domain is
    g. A document of one domain also adds to others, so a domain that is full
    already grows a little. The total is the least one that every target reaches
    if each group's documents are repeated evenly; where a group has no document
    or the groups do not tell the domains apart, the least one without a target
    below ``now``.
    """
    plain = float((now / np.maximum(w, 1e-9)).max())
    sizes = groups.sum(axis=1)
    if not least or (sizes <= 0).any():
        return plain
    mean = (groups / sizes[:, None]).T
    if np.linalg.cond(mean) > 1e6:
        return plain
    grown, had = np.linalg.solve(mean, w), np.linalg.solve(mean, now)
    return max(plain, float((had / grown).max())) if (grown > 0).all() else plain


def _descend(rated: DataFrame, m: np.ndarray, goal: np.ndarray, scale: np.ndarray, least: float) -> tuple[DataFrame, list[dict[str, list[float]]]]:
    """(``rated`` with the fitted ``rate``, history of expected and target domain totals of each round); ``m``: the totals at ``rate``."""
    k = len(goal)
    p, t = [F.col(f"p_{i}") for i in range(k)], F.col("tokens").cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def along(y: np.ndarray) -> Column:
        return sum((c * float(y[i]) for i, c in enumerate(p)), F.lit(0.0))

    def loss(m: np.ndarray) -> float:
        return float(((m - goal) ** 2 / scale).sum() / 2)

    rate: Column = F.col("rate")
    history: list[dict[str, list[float]]] = []
    used, damping, still = 0, DAMPING, False
    while True:
        history.append({"expected": m.tolist(), "target": goal.tolist()})
        error = m - goal
        gradient = error / scale
        if still or np.abs(gradient).max() < TOLERANCE:
            return rated.withColumn("rate", rate), history
        if len(history) % WRITE_EVERY == 0:  # the rates so far, so that no expression grows with the rounds
            rated, rate = stage(rated.withColumn("rate", rate), "mix-rates"), F.col("rate")
        held = (rate <= least) & (along(gradient) > 0)
        row = rated.agg(*[F.sum(F.when(~held, t * p[i] * p[j])).alias(f"h_{i}_{j}") for i, j in pairs]).first()
        h = np.zeros((k, k))
        for i, j in pairs:
            h[i, j] = h[j, i] = row[f"h_{i}_{j}"] or 0.0
        used += 1
        while True:
            move = along(np.linalg.solve(h + damping * np.diag(scale), error))
            there = F.when(held, rate).otherwise(F.greatest(F.lit(least), rate - move))
            row = rated.agg(*[F.sum(there * t * c).alias(f"m_{i}") for i, c in enumerate(p)]).first()
            used += 1
            reached = np.array([row[f"m_{i}"] for i in range(k)])
            promised = float(gradient @ (m - reached))
            if promised > 0 and loss(reached) <= loss(m) - promised / 10:
                break
            damping = max(damping, 1e-7) * 10
            if not h.any() or damping > DAMPING_MOST:  # no step descends
                return rated.withColumn("rate", rate), history
            if used >= LIMIT:
                raise RuntimeError(f"rates have not converged after {used} aggregations: expected domain totals {m.tolist()}, targets {goal.tolist()}")
        still = loss(m) - loss(reached) < STILL * loss(m)
        rate, m, damping = there, reached, max(damping / 10, DAMPING)
        if used >= LIMIT and not still and np.abs((m - goal) / scale).max() >= TOLERANCE:
            raise RuntimeError(f"rates have not converged after {used} aggregations: expected domain totals {m.tolist()}, targets {goal.tolist()}")


def copies(rate: Column, key: Column) -> Column:
    """floor(rate), and one more with the probability of the rest."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, domain: Column, trusted: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text", total: float | None = None, least: float = 0.0) -> DataFrame:
    """One row per row of ``docs``: id, text_key, tokens, p_<domain> ..., rate, copies."""
    members, domains = memberships(docs, domain, trusted, targets, id_col, text_col)
    if total is None and not least:
        total = float(members.agg(F.sum("tokens").alias("n")).first().n or 0) or None
    out, _ = fit_rates(members, [targets[d] for d in domains], total, least) if domains else (members.withColumn("rate", F.lit(1.0)), [])
    named = [F.col(f"p_{domains.index(d)}").alias(f"p_{d}") if d in domains else F.lit(0.0).alias(f"p_{d}") for d in targets]
    return out.select(F.col("id").alias(id_col), "text_key", "tokens", *named, "rate", copies(F.col("rate"), F.concat_ws("/", F.col("id").cast("string"), F.col("text_key").cast("string"))).alias("copies"))


def resample(docs: DataFrame, domain: Column, trusted: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text", least: float = 1.0) -> DataFrame:
    """``docs`` with every row repeated ``copies`` times; at ``least`` = 1 every document stays and rare domains are repeated."""
    decided = mix(docs, domain, trusted, targets, id_col, text_col, least=least)
    # Rows without need of a second copy are found by the anti side; only repeats are joined with text.
    more = stage(decided.filter("copies <> 1").select(F.col(id_col).alias("mix_id"), F.col("text_key").alias("mix_key"), F.col("copies").alias("mix_copies")).distinct(), "mix-copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = F.xxhash64(text_or_empty(F.col("row").getField(text_col)))
    joined = rows.join(more, F.col("row").getField(id_col).eqNullSafe(F.col("mix_id")) & (key == F.col("mix_key")), "left")
    spread = joined.filter("mix_copies IS NULL OR mix_copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("mix_copies", F.lit(1).cast("long")))).alias("copy"))
    return spread.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
