"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected on seeded random directions. On one direction, two vectors of cosine c differ by a normal
number of variance 2 - 2c, so a window of fixed half-width around a query's projection holds a similar vector with a
known chance; the number of windows (one per direction) that hold it is binomial, and the count to demand follows from
the recall asked for. Pairs that reach it are verified by their cosine in double precision.

Vectors are dealt into blocks by hash and every pair of blocks meets in one task, so all vectors are queries against
all others. There the projections of a block are sorted; a window is a range of ranks, held as the difference of two
prefix bit sets, and the counts of all pairs are added up in bit-sliced counters, 64 pairs to a machine word. A task returns one
row per linked vector (its links and a root of the component they span), so a group of near copies never becomes pairs.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginbook.llm.components import components
from marginbook.llm.frames import checkpoint

PROJECTIONS = 32
#: Windows reach so many standard deviations of the difference at the threshold.
REACH = 2.0
RECALL = 0.9999
#: Ranks between two stored prefix sets; windows widen to these.
STRIDE = 128
BLOCK_MOST, BLOCK_LEAST = 32_768, 2_048


def demanded(directions: int, chance: float, recall: float) -> int:
    """Largest count that a binomial number of collisions reaches with probability ``recall`` at least."""
    tail = 0.0
    for count in range(directions, -1, -1):
        tail += comb(directions, count) * chance**count * (1 - chance) ** (directions - count)
        if tail >= recall:
            return count
    return 0


class Windows:
    """Sorted projections of a block, and the bit set of the vectors inside any window of any direction."""

    def __init__(self, projected: np.ndarray) -> None:
        n, directions = projected.shape
        self.sorted = np.sort(projected, axis=0)
        order = np.argsort(projected, axis=0, kind="stable")
        steps = -(-n // STRIDE)
        self.prefixes = []
        for i in range(directions):
            held = np.zeros((steps + 1, -(-n // 64) * 64), bool)
            held[np.arange(n) // STRIDE + 1, order[:, i]] = True
            np.logical_or.accumulate(held, axis=0, out=held)
            self.prefixes.append(np.packbits(held, axis=1, bitorder="little").view(np.uint64))

    def around(self, direction: int, centres: np.ndarray, half: float) -> np.ndarray:
        ranks = self.sorted[:, direction]
        first = np.searchsorted(ranks, centres - half, side="left") // STRIDE
        last = -(-np.searchsorted(ranks, centres + half, side="right") // STRIDE)
        return self.prefixes[direction][last] ^ self.prefixes[direction][first]


def _reached(windows: Windows, queries: np.ndarray, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs whose collisions reach ``least``."""
    directions = queries.shape[1]
    planes: list[np.ndarray] = []
    for i in range(directions):
        carry = windows.around(i, queries[:, i], half)
        for k in range(len(planes)):
            planes[k], carry = planes[k] ^ carry, planes[k] & carry
        if (i + 1).bit_length() > len(planes):
            planes.append(carry)
    over, equal = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
    for k in range(len(planes) - 1, -1, -1):
        if least >> k & 1:
            equal &= planes[k]
        else:
            over |= equal & planes[k]
            equal &= ~planes[k]
    hits = over | equal
    query, word = np.nonzero(hits)
    bits = np.unpackbits(hits[query, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return query[at], word[at] * 64 + bit


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked nodes the smaller label of the two, until nothing changes."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels[:] = shorter


def _blocks(cosine: float, seed: int, recall: float, directions: int):
    spread = sqrt(2 - 2 * cosine)
    least = demanded(directions, erf(REACH / sqrt(2)), recall)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, side, copies = (table.column(c).to_numpy() for c in ("node", "side", "copies"))
        column = table.column("vector")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        vectors = column.flatten().to_numpy().reshape(len(node), -1).astype(np.float64)
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the norm
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        rng = np.random.default_rng([seed, vectors.shape[1]])
        projected = vectors @ rng.standard_normal((vectors.shape[1], directions))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        own = not len(right)
        right = left if own else right
        labels, links = np.arange(len(node)), np.zeros(len(node), np.int64)
        if len(left) and len(right):
            windows = Windows(projected[right])
            batch = max(32, (1 << 16) // max(1, len(right) // 64))
            for start in range(0, len(left), batch):
                rows = left[start:start + batch]
                query, other = _reached(windows, projected[rows], REACH * spread, least)
                a, b = rows[query], right[other]
                if own:
                    a, b = a[a < b], b[a < b]
                for cut in range(0, len(a), 1 << 16):
                    x, y = a[cut:cut + (1 << 16)], b[cut:cut + (1 << 16)]
                    close = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= cosine
                    x, y = x[close], y[close]
                    links += np.bincount(x, copies[y], len(node)).astype(np.int64)
                    links += np.bincount(y, copies[x], len(node)).astype(np.int64)
                    _join_labels(labels, x, y)
        found = np.flatnonzero(links)
        return pa.table({"node": node[found], "links": links[found], "root": node[labels[found]]})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding",
                 directions: int = PROJECTIONS, recall: float = RECALL, seed: int = 29) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Rows whose cosine is at least ``cosine`` are linked; a pair right at the threshold is found with probability
    ``recall`` or more, a closer pair sooner. Vectors that are null, empty, zero or hold a null or non-finite component,
    and rows without id, are linked with nothing; vectors of different lengths aren't compared. Equal vectors are linked with each
    other and count each; repeated ids are rows of their own. A row without id has a null component and isn't kept. An empty table
    gives an empty result; other columns are not read.
    """
    value = F.transform(embedding, lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("vector"))
    sound = (F.col("vec_id").isNotNull() & (F.size("vector") > 0)
             & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("node", F.when(sound, F.xxhash64("vector")))
    distinct = checkpoint(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    sized = distinct.withColumn("dim", F.size("vector"))
    size = F.least(F.lit(BLOCK_MOST), F.greatest(F.lit(BLOCK_LEAST), F.col("n") / 8))
    parts = sized.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select(
        "dim", F.ceil(F.col("n") / size).cast("int").alias("parts"))
    placed = (sized.join(parts, "dim").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    tasks = placed.select(F.concat_ws("-", "dim", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
                          (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "copies", "vector")
    found = checkpoint(tasks.groupBy("task").applyInArrow(
        _blocks(cosine, seed, recall, directions), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = (rows.select("vec_id", "node").join(distinct.select("node", "copies"), "node", "left")
              .join(links, "node", "left").join(roots.withColumnRenamed("root", "top"), "node", "left")
              .withColumn("top", F.coalesce("top", "node")))
    least = placed.where("top IS NOT NULL").groupBy("top").agg(F.min("vec_id").alias("least"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id"))
    return (placed.join(least, "top", "left").withColumn("component_id", component)
            .select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
                    "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")))
