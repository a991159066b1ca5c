"""URL filters: allow and block rules first, a logistic regression on character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled URLs a fit takes to the driver.
LABELLED_ROWS = 20_000
BUCKETS = 1 << 14
GRAMS = (3, 4, 5)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit("")))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits a host and path, and its verdict; nulls where none does.

    A rule is (``allow`` or ``block``, ``host/path``): its host fits itself and all its subdomains, its path every path
    that starts with it. Of rules of one length the first given wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, pattern in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = pattern.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _features(host: str, path: str) -> np.ndarray:
    """Buckets of the character n-grams of host and path, each once."""
    found = {xxhash.xxh3_64_intdigest(mark + s[i:i + n], n) % BUCKETS
             for mark, s in ((b"h", f"^{host}$".encode()), (b"p", f"{path}$".encode()))
             for n in GRAMS for i in range(len(s) - n + 1)}
    return np.fromiter(sorted(found), np.int64, len(found))


def fit_urls(labelled: DataFrame, rows: int = LABELLED_ROWS, epochs: int = 12, rate: float = 0.5,
             decay: float = 1e-5, seed: int = 5) -> np.ndarray:
    """Weights (the last is the constant) learnt from ``labelled`` (host, path, label: 1 allow, 0 block).

    At most ``rows`` distinct URLs are used, those with the smallest hashes; rows with a null are left out. An empty
    table, or one of a single class, gives a constant that favours that class (allow if there is none).
    """
    taken = (labelled.dropna(subset=["host", "path", "label"]).groupBy("host", "path").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("host", "path"), "host", "path").limit(rows).collect())
    weights = np.zeros(BUCKETS + 1)
    classes = {int(r["label"]) for r in taken}
    if len(classes) < 2:
        weights[-1] = -4.0 if classes == {0} else 4.0
        return weights
    inputs = [(_features(r["host"], r["path"]), int(r["label"])) for r in taken]
    share = sum(y for _, y in inputs) / len(inputs)
    balance = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    rng, squares = np.random.default_rng(seed), np.full(BUCKETS + 1, 1e-8)
    for _ in range(epochs):
        for i in rng.permutation(len(inputs)):
            at, label = inputs[i]
            at = np.append(at, BUCKETS)
            scale = 1 / np.sqrt(len(at))
            p = 1 / (1 + np.exp(-np.clip(weights[at].sum() * scale, -30, 30)))
            step = (p - label) * balance[label] * scale + decay * weights[at]
            squares[at] += step * step
            weights[at] -= rate * step / np.sqrt(squares[at])
    return weights


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame,
                url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict`` (allow or block).

    Where a rule fits, the longest decides. Elsewhere the score of a regression decides, which ``fit_urls`` learns from
    ``labelled`` (host, path, label): allow from ``threshold`` on. A null URL, or one without
    ``://``, has an empty host and path and is scored like any other. Repeated rows stay; columns called like the added ones
    are replaced.
    """
    added = ["host", "path", "rule", "score", "verdict"]
    kept = [c for c in pages.columns if c not in added]
    host, path = url_parts(F.col(url))
    rule, ruled = match_rule(F.col("host"), F.col("path"), rules)
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    weights = fit_urls(labelled)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            scores = []
            for h, p in zip(hosts, paths, strict=True):
                at = np.append(_features(h, p), BUCKETS)
                scores.append(1 / (1 + np.exp(-np.clip(weights[at].sum() / np.sqrt(len(at)), -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "score"])
    from pyspark.sql import types as T
    scored = parts.mapInArrow(score, T.StructType([*parts.schema.fields, T.StructField("score", T.DoubleType())]))
    return (scored.withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(ruled, F.when(F.col("score") >= threshold, "allow").otherwise("block")))
            .select(*kept, *added))
