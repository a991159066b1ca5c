"""Quality classifier: regularised quadratic discriminant over transformed statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginbook.llm.frames import checkpoint, raw

UPPER = bytes(range(65, 91))
LOWER_LETTERS = bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS, MARKS, SIGNS, BARS, SHOUTS = b"0123456789", b".,;:?", b"#$%&*@^~=+<>{}[]\\/_", b"|", b"!"
STATISTICS = ("words", "word_length", "upper", "digits", "marks", "signs", "bars", "shouts", "repeats", "distinct",
              "top_word", "line_length", "line_repeats", "long_words", "capital_words")


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a text, in the order of ``STATISTICS``; null counts as empty."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    solid = sum(map(len, words))
    count = lambda kinds: size - len(text.translate(None, kinds))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    # Shares per hundred: how much of a text, not how many characters, so that length has one statistic only.
    per = lambda part, whole: float(np.log(0.2 + 100 * part / whole)) if whole else float(np.log(0.2))
    return [
        float(np.log1p(n)), float(np.log1p(solid / n)) if n else 0.0, per(count(UPPER), solid), per(count(DIGITS), solid),
        per(count(MARKS), solid), per(count(SIGNS), solid), per(count(BARS), solid), per(count(SHOUTS), solid),
        per(same, n), float(np.log(len(counts) / n)) / (1 + float(np.log(n))) if n else 0.0,
        per(max(counts.values(), default=0), n), float(np.log1p(n / len(lines))) if lines else 0.0,
        per(len(lines) - len(set(lines)), len(lines)), per(sum(len(w) > 12 for w in words), n),
        per(sum(w[:1].isupper() for w in words), n)]


@dataclass
class Discriminant:
    """Two Gaussians with their Cholesky factors, and the log ratio of their priors."""

    means: np.ndarray
    factors: np.ndarray
    offset: float

    @classmethod
    def fit(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float) -> Discriminant | None:
        """From (rows, sums, sums of products) per class. A class covariance is mixed with the pooled one (``shrink``) and with the
        pooled variances (``shrink`` of the rest), which keeps it invertible. None if a class has no rows."""
        if any(moments.get(k, (0,))[0] < 1 for k in (0, 1)):
            return None
        means, scatters, rows = [], [], []
        for k in (0, 1):
            n, total, products = moments[k]
            mean = total / n
            means.append(mean)
            scatters.append(products / n - np.outer(mean, mean))
            rows.append(n)
        pooled = (rows[0] * scatters[0] + rows[1] * scatters[1]) / sum(rows)
        spread = np.diag(np.diag(pooled) + 1e-3)
        factors = [np.linalg.cholesky((1 - shrink) * ((1 - shrink) * s + shrink * pooled) + shrink * spread) for s in scatters]
        # Quadratic scores of correlated statistics are too sure of themselves; the offset uses the log prior alone.
        return cls(np.array(means), np.array(factors), float(np.log(rows[1] / rows[0])))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 by the difference of the log densities."""
        densities = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            white = np.linalg.solve(factor, (x - mean).T)
            densities.append(-0.5 * (white**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(densities[1] - densities[0] + self.offset, -500, 500)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(t) for t in raw(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(values, pa.list_(pa.float64()))],
                                         names=["doc", "x"])


def fit_quality(measured: DataFrame, labels: DataFrame, shrink: float = 0.1) -> Discriminant | None:
    """Learn from ``measured`` (doc, x) and ``labels`` (doc, label 0 or 1), all rows; only class sums reach the driver."""
    d = len(STATISTICS)
    known = measured.join(labels.where("doc IS NOT NULL AND label IN (0, 1)"), "doc")
    products = F.flatten(F.transform("x", lambda a: F.transform("x", lambda b: a * b)))
    sums = (known.select("label", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("x"), products)).alias("at", "v"))
            .groupBy("label", "at").agg(F.sum("v").alias("v")).collect())
    flat = {k: np.zeros(1 + d + d * d) for k in (0, 1)}
    for r in sums:
        flat[r["label"]][r["at"]] = r["v"]
    return Discriminant.fit({k: (v[0], v[1:1 + d], v[1 + d:].reshape(d, d)) for k, v in flat.items()}, shrink)


def score_quality(docs: DataFrame, labels: DataFrame, shrink: float = 0.1, doc_id: str = "doc_id", text: str = "text",
                  label_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) per row of ``docs``, learnt from ``labels``.

    Only the text is scored. Null and empty texts have the statistics of no words and are scored like others; rows of ``docs``
    without id are scored but not learnt from; repeated rows and repeated labels count each; null labels are left out. If
    a class has no labelled row, or ``labels`` is empty, every score is 0.5. Other columns are not read.
    """
    measured = checkpoint(docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
                          .mapInArrow(_measure, "doc long, x array<double>"))
    model = fit_quality(measured, labels.select(F.col(label_id).cast("long").alias("doc"), F.col(label).cast("int").alias("label")),
                        shrink)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = model.score(x) if model and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores)], names=["doc_id", "score"])
    return measured.mapInArrow(run, "doc_id long, score double")
