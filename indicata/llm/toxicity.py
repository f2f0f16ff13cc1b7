"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the set of its character n-grams (3 to 5 characters of ``<word>``)
and itself, hashed into ``BUCKETS`` rows of an embedding table; its vector is
their mean, so a misspelling that was never seen shares most of its vector
with the word it misspells. A window of ``WINDOW`` words is the mean of its
words' vectors, and a linear softmax maps it to two classes. Embeddings and
softmax are trained jointly in numpy (Adagrad). Windows overlap by half and
cover the whole text; a text scores as its most toxic window, so a few words
in a long document are not averaged away, and training uses the same rule:
each document contributes its currently most toxic window. The embeddings
start from how much more often toxic than clean documents hold each n-gram,
so that the first windows chosen are not random.

Training reads a bounded sample of labelled rows: at most ``TRAIN_DOCS`` of
each class, chosen by a hash of the id, of texts up to ``TRAIN_CHARS``
characters. It runs in one task over that sample; scoring runs on all rows.

Defined results: null and empty texts have no words and score as the bias
alone, which is below every threshold used here. Labels that are null are
ignored, and of repeated labels of one id the largest counts. Without labelled
rows of both classes every text scores 0 (below 1e-9). Rows with a null id are scored, and
are never learned from. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 19
DIM = 8
GRAMS = (3, 4, 5)
WINDOW = 8
TRAIN_DOCS = 4_000
TRAIN_CHARS = 65_536
EPOCHS = 6
#: Weight of the document-frequency start in the embeddings, and of the empty text as a clean example.
LEAN, EMPTY = 2.0, 0.1
RATE, SOFT_RATE = 0.2, 0.2
THRESHOLD = 0.7
#: Word scores a Python worker remembers at most.
CACHE_WORDS = 150_000
#: Texts, and new words, that it scores at a time.
TEXTS, NEW_WORDS = 64, 20_000

WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): for each word the buckets of its n-grams and of itself, concatenated."""
    spans = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(spans)
    owner = np.repeat(np.arange(len(words)), spans)
    end_of = ends[owner]
    position = np.arange(len(chars))
    hashed, whose = [], []
    rolling = np.zeros(len(chars), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros(len(chars), np.uint64)
        shifted[: max(0, len(chars) - n + 1)] = chars[n - 1 :]
        rolling = rolling * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(n)
        if n in GRAMS:
            ok = position + n <= end_of
            hashed.append(rolling[ok] ^ (rolling[ok] >> np.uint64(29)))
            whose.append(owner[ok])
    # the word itself: a sum over its characters and their places
    places = (position - (ends - spans)[owner]).astype(np.uint64)
    mixed = (chars + np.uint64(1)) * ((places * np.uint64(2) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    whole = np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), ends - spans) if len(words) else np.empty(0, np.uint64)
    hashed.append(whole ^ (whole >> np.uint64(29)))
    whose.append(np.arange(len(words)))
    owners = np.concatenate(whose)
    order = np.argsort(owners, kind="stable")
    buckets = (np.concatenate(hashed)[order] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS
    counts = np.bincount(owners, minlength=len(words))
    return buckets, np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def sliced_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_features`` of many words, with the working memory of a few."""
    buckets, starts, seen = [], [], 0
    for k in range(0, len(words), NEW_WORDS):
        b, s = word_features(words[k : k + NEW_WORDS])
        buckets.append(b.astype(np.int32))
        starts.append(s + seen)
        seen += len(b)
    return (np.concatenate(buckets), np.concatenate(starts)) if words else (np.empty(0, np.int32), np.empty(0, np.int64))


@dataclass
class Model:
    """Folded for scoring: each bucket's share of the log-odds, and the bias."""

    gram: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0, np.float64)
        buckets, starts = word_features(words)
        sums = np.add.reduceat(self.gram[buckets], starts)
        return sums / np.diff(np.append(starts, len(buckets)))


def windows(n: int, width: int = WINDOW) -> np.ndarray:
    """Starts of half-overlapping windows that cover n words; one window if they all fit."""
    if n <= width:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - width, width // 2), n - width)


def best_window(scores: np.ndarray, width: int = WINDOW) -> tuple[int, float]:
    """(start, mean) of the window with the largest mean word score."""
    if not len(scores):
        return 0, 0.0
    total = np.concatenate([[0.0], np.cumsum(scores)])
    starts = windows(len(scores), width)
    ends = np.minimum(starts + width, len(scores))
    means = (total[ends] - total[starts]) / (ends - starts)
    k = int(np.argmax(means))
    return int(starts[k]), float(means[k])


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


class Vocabulary:
    """Training texts as arrays of word numbers, and the n-gram buckets of each word."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[str, int] = {}
        self.docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64) for t in texts]
        self.size = len(numbers)
        self.buckets, self.starts = sliced_features(list(numbers))
        self.counts = np.diff(np.append(self.starts, len(self.buckets)))

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, first): the buckets of the given words, concatenated, and where each word's begin."""
        spans = self.counts[words]
        first = np.concatenate([[0], np.cumsum(spans)[:-1]])
        return self.buckets[np.repeat(self.starts[words] - first, spans) + np.arange(spans.sum())], first


def leanings(vocabulary: Vocabulary, y: np.ndarray) -> np.ndarray:
    """For each bucket the log-odds of its document frequency in the two classes, in standard errors."""
    seen = np.zeros((2, BUCKETS))
    for d, label in zip(vocabulary.docs, y):
        if len(d):
            seen[label, np.unique(vocabulary.grams(np.unique(d))[0])] += 1
    n = np.array([[(y == 0).sum()], [(y == 1).sum()]])
    some = seen + n / n.sum()  # an n-gram that was never seen leans nowhere
    odds = np.log(some[1] / n[1]) - np.log(some[0] / n[0])
    return np.clip(odds / np.sqrt(1 / some[1] + 1 / some[0]), -3, 10)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Joint training of embeddings and softmax on each text's currently most toxic window."""
    rng = np.random.default_rng(seed)
    vocabulary, y = Vocabulary(texts), np.array(labels, np.int64)
    if not vocabulary.size or len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), -500.0)
    table, soft, bias = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), rng.uniform(-0.5, 0.5, (DIM, 2)), np.array([1.5, -1.5])
    table[:, 0] += LEAN * leanings(vocabulary, y)
    soft[0] = (-0.5, 0.5)
    seen_table, seen_soft, seen_bias = np.full(BUCKETS, 1e-6), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)

    for _ in range(epochs):
        folded = (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32)
        word_score = np.add.reduceat(folded[vocabulary.buckets], vocabulary.starts) / vocabulary.counts
        bags = [d[s : s + WINDOW] for d in vocabulary.docs for s in [best_window(word_score[d])[0]]]
        order = rng.permutation([i for i, b in enumerate(bags) if len(b)])
        for k in range(0, len(order), 128):
            batch = order[k : k + 128]
            size = np.array([len(bags[i]) for i in batch])
            own, inverse = np.unique(np.concatenate([bags[i] for i in batch]), return_inverse=True)
            grams, first = vocabulary.grams(own)
            spans = vocabulary.counts[own]
            vectors = np.add.reduceat(table[grams], first, axis=0) / spans[:, None]
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            mean = np.add.reduceat(vectors[inverse], begin, axis=0) / size[:, None]
            error = softmax(mean @ soft + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            error *= weight[batch][:, None] / len(batch)
            empty = softmax(bias)
            empty[0] -= 1
            g_soft, g_bias, g_mean = mean.T @ error, error.sum(axis=0) + EMPTY * empty, (error @ soft.T) / size[:, None]
            row = np.repeat(np.arange(len(batch)), size)
            g_word = np.stack([np.bincount(inverse, g_mean[row, c], len(own)) for c in range(DIM)], axis=1) / spans[:, None]
            touched, where = np.unique(grams, return_inverse=True)
            spread = np.repeat(np.arange(len(own)), spans)
            g_table = np.stack([np.bincount(where, g_word[spread, c], len(touched)) for c in range(DIM)], axis=1)
            seen_table[touched] += (g_table**2).mean(axis=1)
            table[touched] -= RATE * g_table / np.sqrt(seen_table[touched])[:, None]
            seen_soft += g_soft**2
            soft -= SOFT_RATE * g_soft / np.sqrt(seen_soft)
            seen_bias += g_bias**2
            bias -= SOFT_RATE * g_bias / np.sqrt(seen_bias)
    return Model(table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))


# --- Spark -------------------------------------------------------------------------


def held_out(id_col: str | Column = "doc_id") -> Column:
    """The fold that is never learned from; a null id belongs to it."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = TRAIN_DOCS) -> DataFrame:
    """(id, label, text) of at most ``per_class`` learning ids of each class, the smallest text of each."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL AND label IN (0, 1)")
    known = known.filter(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    order = F.xxhash64("id", F.lit("toxicity"))
    ids = known.filter("label = 1").orderBy(order, "id").limit(per_class).unionByName(known.filter("label = 0").orderBy(order, "id").limit(per_class))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") <= TRAIN_CHARS)
    known_texts = texts.join(F.broadcast(ids), "id")  # at most 2 x per_class ids
    return known_texts.groupBy("id", "label").agg(F.min("text").alias("text"))  # one text of an id that repeats


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = TRAIN_DOCS) -> Model:
    """Train on the bounded sample, in one task; the model (about 1 MB) comes back."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        m = train(pdf["text"].tolist(), pdf["label"].tolist())
        return pd.DataFrame({"model": [pickle.dumps((m.gram.astype(np.float32), m.bias))]})

    sample = labelled_sample(docs, labels, id_col, text_col, label_col, per_class)
    rows = sample.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "model binary").collect()
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), -500.0)
    gram, bias = pickle.loads(rows[0].model)
    return Model(gram, bias)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function text -> score in [0, 1]."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for texts in batches:
            out = np.empty(len(texts))
            for first in range(0, len(texts), TEXTS):
                bags = [words_of(t) for t in texts.iloc[first : first + TEXTS]]
                new = list({w for b in bags for w in b if w not in cache})
                if len(cache) + len(new) > CACHE_WORDS:
                    cache.clear()
                    new = list({w for b in bags for w in b})
                for k in range(0, len(new), NEW_WORDS):
                    cache.update(zip(new[k : k + NEW_WORDS], model.word_scores(new[k : k + NEW_WORDS]).tolist()))
                for k, b in enumerate(bags):
                    s = np.fromiter(map(cache.__getitem__, b), np.float64, len(b))
                    out[first + k] = sigmoid(model.bias + best_window(s)[1])
            yield pd.Series(out)

    return score


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct, and its score."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), scorer(model)(F.col(text_col)).alias("score"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns."""
    kept = score_documents(docs, model, text_col).filter(F.col("score") < threshold)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
