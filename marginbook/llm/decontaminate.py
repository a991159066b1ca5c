"""Benchmark decontamination by an FM-index over each shard of documents.

A shard is a chunk of documents as one sequence of benchmark-vocabulary numbers. A word outside that vocabulary can't be
part of any phrase, so stretches without a phrase's worth of known words shrink to one separator; the index
(suffix order, wavelet-tree ranks of its last column, sampled suffix positions) covers the rest. All phrases are searched
backwards at once, their occurrences located, and overlapping ones merged into removal spans. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginbook.llm.frames import LOWER, checkpoint, groups_of, raw, text_bytes

SHARD_BYTES = 8 << 20
#: Words of benchmark text sent to the tasks at once; a larger benchmark is searched in several passes.
PHRASE_WORDS = 500_000
#: One suffix position in so many is stored.
SAMPLE = 8
#: Bytes that are no part of a word become spaces, A-Z lower case.
WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in LOWER)


def item_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after A-Z are lower-cased."""
    return (text or b"").translate(WORD_BYTES).split()


class WaveletTree:
    """Ranks of symbols in a sequence, by one bit vector per level (the tree's nodes of a level lie side by side)."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.levels = []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            before = np.concatenate([[0], np.cumsum(ones)]).astype(np.int32)
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        first, last = np.zeros_like(ends), ends
        for bit, before, zeros in self.levels:
            one = (symbols >> bit & 1).astype(bool)
            a, b = before[first], before[last]
            first = np.where(one, zeros + a, first - a)
            last = np.where(one, zeros + b, last - b)
        return last - first


class FMIndex:
    """Backward search and location in a sequence of symbols; 0 separates, and no phrase contains it."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        n = len(symbols)
        breaks = symbols == 0
        n_breaks = int(breaks.sum())
        # Each separator is a symbol of its own here, so suffixes differ within a run's length.
        rank = np.where(breaks, np.cumsum(breaks) - 1, symbols.astype(np.int64) + n_breaks)
        span = 1
        while True:
            after = np.concatenate([rank[span:] + 1, np.zeros(min(span, n), np.int64)])
            key = rank * (max(n, alphabet + n_breaks) + 2) + after
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            new = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            span *= 2
        last = symbols[order - 1]  # the symbol before each suffix; before the first stands the closing separator
        self.tree = WaveletTree(last, alphabet)
        self.last = last
        counts = np.bincount(symbols, minlength=alphabet)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        # Run starts are stored as well: behind them the walk to a stored position would cross a separator.
        kept = (order % SAMPLE == 0) | (last == 0)
        self.stored = kept
        self.slot = np.cumsum(kept) - 1
        self.positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [start, stop) of each phrase (a row of the matrix), by backward search."""
        start = np.zeros(len(phrases), np.int64)
        stop = np.full(len(phrases), len(self.last), np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            base = self.first[symbol]
            start[alive] = base + self.tree.rank(symbol, start[alive])
            stop[alive] = base + self.tree.rank(symbol, stop[alive])
            alive = alive[start[alive] < stop[alive]]
            if not len(alive):
                break
        return start, np.maximum(start, stop)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of rows: step back to the nearest stored suffix position."""
        out, steps = np.empty(len(rows), np.int64), 0
        left, at = np.arange(len(rows)), rows
        while len(left):
            done = self.stored[at]
            out[left[done]] = self.positions[self.slot[at[done]]] + steps
            left, at = left[~done], at[~done]
            symbol = self.last[at]
            at = self.first[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return out


@dataclass
class Phrases:
    """Distinct windows of benchmark items by length, and the items that have each."""

    vocabulary: dict[bytes, int]
    by_length: list[tuple[np.ndarray, list[tuple[int, ...]]]]
    shortest: int

    @classmethod
    def of(cls, items: list[tuple[int | None, bytes]], width: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in item_words(text)]
            for i in range(max(1, len(numbers) - width + 1) if numbers else 0):
                owners = found.setdefault(tuple(numbers[i:i + width]), set())
                if item is not None:
                    owners.add(item)
        lengths = sorted({len(p) for p in found})
        by_length = []
        for n in lengths:
            own = [p for p in found if len(p) == n]
            by_length.append((np.array(own, np.int64), [tuple(sorted(found[p])) for p in own]))
        return cls(vocabulary, by_length, min(lengths, default=0))


def _search_shard(texts: list[bytes | None], phrases: Phrases) -> tuple[list[int], list[list], list[set]]:
    """Per document: words, merged spans of hit words, items that have a window in it."""
    get = phrases.vocabulary.get
    numbers, lengths = [], []
    for text in texts:
        words = item_words(text)
        lengths.append(len(words))
        numbers.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        numbers.append(np.zeros(1, np.int64))
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    # Keep runs of known words as long as the shortest phrase, each behind one separator.
    known = np.diff(np.concatenate([[0], (flat > 0).astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
    long = ends - begins >= phrases.shortest
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return lengths, spans, items
    sizes = ends - begins + 1
    opens = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(opens - begins, sizes)  # the closing separator is a run's own
    symbols = flat[place]
    symbols[opens + sizes - 1] = 0
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    borders = np.cumsum(np.array(lengths) + 1)
    edge = np.zeros(len(flat) + 1, np.int64)
    for matrix, owners in phrases.by_length:
        start, stop = index.search(matrix)
        count = stop - start
        hit = np.repeat(np.arange(len(matrix)), count)
        if not len(hit):
            continue
        rows = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        at = place[index.locate(rows)]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + matrix.shape[1], -1)
        pairs = np.unique(np.stack([np.searchsorted(borders, at, side="right"), hit]), axis=1)
        for doc, phrase in pairs.T.tolist():
            items[doc].update(owners[phrase])
    covered = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
    owner = np.searchsorted(borders, begins, side="right")
    offset = borders - np.array(lengths) - 1
    for doc, a, b in zip(owner.tolist(), begins.tolist(), ends.tolist(), strict=True):
        spans[doc].append((a - int(offset[doc]), b - int(offset[doc])))
    return lengths, spans, items


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def _pass(phrases: Phrases, added: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, text_bytes("_text"), SHARD_BYTES):
            texts = [t for b in group for t in raw(b.column("_text"))]
            lengths, spans, items = _search_shard(texts, phrases)
            done = 0
            for batch in group:
                part = slice(done, done + batch.num_rows)
                done += batch.num_rows
                old = [batch.column("spans").to_pylist(), batch.column("items").to_pylist()]
                new_spans = [_union([(s["start"], s["end"]) for s in o] + n) if o else _union(n)
                             for o, n in zip(old[0], spans[part], strict=True)]
                new_items = [sorted(set(o) | n) if o else sorted(n) for o, n in zip(old[1], items[part], strict=True)]
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                values = {"n_words": pa.array(lengths[part], pa.int64()),
                          "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in new_spans], span),
                          "items": pa.array(new_items, pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays(
                    [values.get(n, c) if n in added else c
                     for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", phrase_words: int = PHRASE_WORDS,
                  nameless: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (array of (start, end) in words) and ``items`` (sorted ids).

    A window is ``width`` consecutive words of an item; an item of fewer words is one window, an item of none has none.
    ``spans`` covers every word inside an occurrence of a window, ``items`` are the items with one. Null and empty texts
    have no words, spans or items; items with one id count as one. Items with a null id are left out, or if ``nameless``, count in
    ``spans`` and are missing in ``items`` only. Repeated rows stay.
    An empty table on either side gives no hits. Columns of ``docs`` called like the added ones are replaced.

    The benchmark goes to the driver and the tasks in slices of about ``phrase_words`` words by hash of the item, each
    searched in a pass of its own over the documents; the usual benchmark is one slice. With several, each pass is written to the
    shared folder before the next slice is read, so one slice at a time is in memory.
    """
    added = ["n_words", "spans", "items"]
    kept = [c for c in docs.columns if c not in added]
    items = benchmark.where((F.col(item_id).isNotNull() | F.lit(nameless)) & F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("words"))
    total = items.agg(F.sum(F.length("words"))).first()[0] or 0
    slices = max(1, -(-total // (6 * phrase_words)))
    span = "array<struct<start:int,end:int>>"
    out = docs.select(*kept, F.col(text).alias("_text"), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast(span).alias("spans"), F.array().cast("array<bigint>").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema.fields])
    for k in range(slices):
        own = items if slices == 1 else items.where(F.pmod(F.xxhash64("item", "words"), F.lit(slices)) == k)
        phrases = Phrases.of([(r["item"], r["words"].encode()) for r in own.collect()], width)
        out = out.mapInArrow(_pass(phrases, added), schema)
        if k + 1 < slices:
            del phrases
            out = checkpoint(out)
    return out.select(*kept, *added)


def cut_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the words of ``spans`` cut out of ``text``, from the first to the last byte of each span."""
    import re
    word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            cuts = batch.column(batch.schema.get_field_index(spans)).to_pylist()
            out = []
            for value, own in zip(raw(column), cuts, strict=True):
                if value is not None and own:
                    found = list(word.finditer(value))
                    parts, last = [], 0
                    for s in own:
                        parts.append(value[last:found[s["start"]].start()])
                        last = found[s["end"] - 1].end()
                    value = b"".join([*parts, value[last:]])
                out.append(value)
            columns = [*batch.columns]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return docs.mapInArrow(run, docs.schema)
