"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (hashed into buckets), a text the mean of its distinct words,
each with the weight 1 + log of its count, so that a word said a thousand times is not the whole text. Vectors and softmax
are trained jointly, so words that were never seen, misspellings among them, share the vectors of their n-grams. A group
penalty holds the vectors of n-grams that tell nothing at zero. Since both means and the softmax's inputs are linear, a
fitted model is one number per bucket. A fifth of the labelled texts is kept back to turn its evidence into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginbook.llm.frames import LOWER, raw, small_batches

BUCKETS = 1 << 17
#: Lengths in bytes of the n-grams anywhere in a word with its ends marked, and of those at its start only.
GRAMS, STARTS = (4, 5, 6), (7, 8, 9, 10)
#: Added to the weight of a text's words: a single word says less in a short text.
SHRINK = 10.0
#: Buckets in fewer training texts are not learnt from.
LEAST_TEXTS = 3
#: Most labelled rows of each class that a fit takes to the driver; those with the smallest hashes of the id.
ROWS_PER_CLASS = 3_000
#: Most bytes of their texts; whole texts are taken in the order of the hashes until it is reached.
BYTES_PER_CLASS = 12 << 20
#: Words whose n-grams are kept in a fit, and words whose evidence is kept in scoring.
KNOWN_WORDS, SCORED_WORDS = 100_000, 250_000
#: Bytes that are no part of a word become spaces, A-Z lower case: marks stuck to a word don't hide it.
LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in LOWER)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def buckets_of(word: bytes) -> set[int]:
    """Buckets of a word: the word itself, its n-grams with marked ends, and its longer beginnings."""
    marked, digest = b"<" + word + b">", xxhash.xxh3_64_intdigest
    size = len(marked)
    found = {digest(marked) % BUCKETS}
    for n in GRAMS:
        found.update([digest(marked[i:i + n], n) % BUCKETS for i in range(size - n + 1)])
    found.update([digest(marked[:n], n) % BUCKETS for n in STARTS if n < size])
    return found


def grams_of(word: bytes) -> np.ndarray:
    return np.array(sorted(buckets_of(word)), np.int32)


def _bag(text: bytes, known: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights."""
    counts = Counter(words_of(text))
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    at, weights, total = [], [], SHRINK
    for word, n in counts.items():
        if (grams := known.get(word)) is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            grams = known[word] = grams_of(word)
        weight = 1 + np.log(n)
        total += weight
        at.append(grams)
        weights.append(np.full(len(grams), weight / len(grams)))
    at, place = np.unique(np.concatenate(at), return_inverse=True)
    return at, (np.bincount(place, np.concatenate(weights)) / total).astype(np.float32)


def _logistic(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and constant of a logistic curve through evidence and labels, by damped Newton steps."""
    x = np.stack([z, np.ones(len(z))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + 1e-2 * w * [1, 0]
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w -= np.linalg.solve(curve, slope)
    return max(float(w[0]), 1e-6), float(w[1])


@dataclass
class SubwordModel:
    """The evidence of each bucket for class 1, and the constant."""

    evidence: np.ndarray
    constant: float

    @classmethod
    def fit(cls, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, dim: int = 8, epochs: int = 8,
            rate: float = 0.1, penalty: float = 3e-4, batch: int = 32, scale: float = 100.0, seed: int = 11) -> SubwordModel:
        """Adagrad on the cross entropy with classes weighted alike. ``weights`` says how many rows of the population a row
        of each class stands for, for the probabilities."""
        known: dict[bytes, np.ndarray] = {}
        bags = [_bag(t, known) for t in texts]
        known.clear()
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(bags))
        back = set(order[:len(order) // 5].tolist()) if min(np.bincount(labels, minlength=2)) >= 20 else set()
        own = np.array([i for i in order if i not in back])
        seen = np.zeros(BUCKETS, np.int32)
        for i in own:
            seen[bags[i][0]] += 1
        for i, (at, w) in enumerate(bags):
            kept = seen[at] >= LEAST_TEXTS
            bags[i] = at[kept], w[kept]
        vectors = rng.uniform(-0.05 / dim, 0.05 / dim, (BUCKETS, dim))
        soft = np.array([-0.5, 0.5]) + rng.normal(0, 0.1, (dim, 2))
        bias = np.zeros(2)
        squares = [np.full(BUCKETS, 1e-4), np.full(soft.shape, 1e-2), np.full(2, 1e-2)]
        touched, where = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int64)
        balance = 0.5 / np.maximum(1e-9, np.bincount(labels[own], minlength=2) / len(own))
        for _ in range(epochs):
            rng.shuffle(own)
            for start in range(0, len(own), batch):
                rows = [i for i in own[start:start + batch] if len(bags[i][0])]
                if not rows:
                    continue
                at = np.concatenate([bags[i][0] for i in rows])
                weight = np.concatenate([bags[i][1] for i in rows]) * scale
                row = np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows])
                hidden = np.stack([np.bincount(row, vectors[at, k] * weight, len(rows)) for k in range(dim)], axis=1)
                logits = hidden @ soft + bias
                error = np.exp(logits - logits.max(axis=1, keepdims=True))
                error /= error.sum(axis=1, keepdims=True)
                error[np.arange(len(rows)), labels[rows]] -= 1
                error *= balance[labels[rows]][:, None] / len(rows)
                down = error @ soft.T
                touched[at] = True
                buckets = np.flatnonzero(touched)
                touched[buckets] = False
                where[buckets] = np.arange(len(buckets))
                place = where[at]
                step = np.stack([np.bincount(place, down[row, k] * weight) for k in range(dim)], axis=1)
                squares[0][buckets] += (step**2).mean(axis=1)
                pace = rate / np.sqrt(squares[0][buckets])[:, None]
                moved = vectors[buckets] - pace * step
                norm = np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
                vectors[buckets] = moved * np.maximum(0, 1 - pace * penalty / norm)
                for value, grad, square in ((soft, hidden.T @ error, squares[1]), (bias, error.sum(axis=0), squares[2])):
                    square += grad**2
                    value -= 0.2 * rate * grad / np.sqrt(square)
        evidence = vectors @ (soft[:, 1] - soft[:, 0]) * scale
        evidence[seen < LEAST_TEXTS] = 0
        z = np.array([evidence[at] @ w if len(at) else 0.0 for at, w in bags])
        check = np.array(sorted(back)) if back else np.arange(len(bags))
        slope, constant = _logistic(z[check], labels[check])
        ratio = np.bincount(labels[check], minlength=2)
        shift = np.log(weights[1] / weights[0]) - np.log(ratio[1] / ratio[0]) if ratio.min() else 0.0
        return cls(evidence * slope, constant + float(shift))

    def scorer(self):
        """A function from a text to its score; it keeps the evidence of the words met lately."""
        known: dict[bytes, float] = {}
        evidence = self.evidence.tolist()

        def score(text: bytes | None) -> float:
            total, weight = 0.0, SHRINK
            for word, n in Counter(words_of(text)).items():
                value = known.get(word)
                if value is None:
                    if len(known) >= SCORED_WORDS:
                        known.clear()
                    buckets = buckets_of(word)
                    value = known[word] = sum(map(evidence.__getitem__, buckets)) / len(buckets)
                share = 1 + log(n)
                total += share * value
                weight += share
            return 1 / (1 + exp(-max(-500.0, min(500.0, self.constant + total / weight))))
        return score


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS, most: int = BYTES_PER_CLASS,
                 seed: int = 11) -> SubwordModel | None:
    """Learn from whole texts of at most ``rows`` rows and about ``most`` bytes per class: ``docs`` (doc, text) and
    ``labels`` (doc, label 0 or 1). None if a class has no row."""
    given = labels.where("doc IS NOT NULL AND label IN (0, 1)")
    counts = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    # The ids are drawn first, so that only their texts are moved.
    drawn = None
    for k in (0, 1):
        own = given.where(F.col("label") == k).orderBy(F.xxhash64("doc", F.lit(seed)), "doc").limit(rows)
        drawn = own if drawn is None else drawn.union(own)
    texts, given_labels, size = [], [], [0, 0]
    chosen = docs.join(F.broadcast(drawn), "doc").where("text IS NOT NULL")
    for r in chosen.orderBy(F.xxhash64("doc", F.lit(seed)), "doc", "label").toLocalIterator():
        if size[r["label"]] < most:
            value = r["text"].encode()
            size[r["label"]] += len(value)
            texts.append(value)
            given_labels.append(r["label"])
    known = np.array(given_labels, np.int64)
    if len(set(given_labels)) < 2:
        return None
    return SubwordModel.fit(texts, known, np.array([counts[0], counts[1]], float), seed=seed)


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label_id: str = "doc_id", label: str = "toxic", column: str = "score") -> DataFrame:
    """``docs`` with ``column``: the probability (0 to 1) that the whole text is toxic, learnt from ``labels``.

    Only the text is scored. Null and empty texts, and texts without a letter or digit, get the score of no evidence. Rows
    without id are scored, not learnt from; null labels are left out; repeated rows stay, and count each in the fit. If a
    class has no labelled row, or either table is empty, every score is 0. A column of ``docs`` called like the
    added one is replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != column]
    model = fit_toxicity(docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")),
                         labels.select(F.col(label_id).cast("long").alias("doc"), F.col(label).cast("int").alias("label")))
    rows = docs.select(*kept)
    if model is None:
        return rows.withColumn(column, F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = [score(t) for t in raw(batch.column(batch.schema.get_field_index(text)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, column])
    from pyspark.sql import types as T
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(column, T.DoubleType())]))
