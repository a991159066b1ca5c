"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes counted in Spark.

A window is ``width`` consecutive words of one document. Words covered by a window that also occurs in a document with a
smaller id are removed. Three steps, none of which holds more than one block of data in a task:

1. Map: a chunk of documents becomes the hashes of all its windows. Windows that repeat inside the chunk are
   settled there, so a hot passage or a hot group of copies leaves each chunk only once. The rest go out in one packed block per
   hash range (``bucket``): seven bytes of hash, and the steps in place and document id from one window to the next.
2. Reduce by bucket: a hash seen in several documents marks its windows outside the smallest of them.
3. Reduce by chunk: marked windows merge into maximal intervals of each document.

Buckets are ranges of a uniform hash, eight for each shuffle partition, so they are even whatever the texts repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from marginbook.llm.frames import groups_of, raw, shuffle_partitions, text_bytes
from marginbook.llm.words import WordHashes, mix, windows

CHUNK_BYTES = 8 << 20
BUCKETS_PER_PARTITION = 8
HASH_BYTES = 7

BLOCK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("places", pa.binary()),
                   ("ids", pa.binary()), ("keys", pa.binary()), ("lengths", pa.binary()), ("marked", pa.binary())])
FOUND = pa.schema([("chunk", pa.int64()), ("marked", pa.binary()), ("ids", pa.binary()), ("keys", pa.binary()),
                   ("lengths", pa.binary())])
SPANS = pa.schema([("_id", pa.int64()), ("_key", pa.int64()),
                   ("_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, byte by byte: the high bytes compress to nothing."""
    wide = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(wide[:, :width].T).tobytes()


def _unplane(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u8").ravel()


def _steps(values: np.ndarray) -> bytes:
    """Values in the order of places, as compressed differences."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    return zstandard.compress(_planes(steps.view(np.uint64), 8), 1)


def _unstep(data: bytes) -> np.ndarray:
    return np.cumsum(_unplane(zstandard.decompress(data), 8).view(np.int64))


def _later(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True for each window whose hash also belongs to a document with a smaller id."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    ids = docs[order]
    least = np.minimum.reduceat(ids, starts)
    out = np.empty(len(hashes), bool)
    out[order] = ids > np.repeat(least, np.diff(np.append(starts, len(hashes))))
    return out


def _pack_chunk(chunk: int, hashes: np.ndarray, at: np.ndarray, docs: np.ndarray, tables: tuple, buckets: int):
    """Rows of ``BLOCK`` for the windows of a chunk; ``at`` are their places in the chunk, ``docs`` their ids."""
    later = _later(hashes, docs)
    ids, keys, lengths = tables
    # The table of the chunk's documents and the windows settled here travel once, in some bucket.
    yield (chunk % buckets, chunk, None, None, ids.tobytes(), keys.tobytes(), lengths.tobytes(),
           at[later].astype("<u4").tobytes())
    hashes, at, docs = hashes[~later], at[~later], docs[~later]
    bucket = ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(
        np.uint16 if buckets < 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    ranked = bucket[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else []
    for start, stop in zip(starts, np.append(starts[1:], len(ranked)) if len(ranked) else [], strict=True):
        own = order[start:stop]
        yield (int(ranked[start]), chunk, _planes(hashes[own], HASH_BYTES), _steps(at[own]), _steps(docs[own]),
               None, None, None)


def _blocks(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        part = TaskContext.get().partitionId()
        for number, group in enumerate(groups_of(batches, text_bytes("text"), CHUNK_BYTES)):
            parts, ids, keys, lengths = [], [], [], []
            for batch in group:
                for text, doc, key in zip(raw(batch.column("text")), batch.column("_id").to_pylist(),
                                          batch.column("_key").to_pylist(), strict=True):
                    words = text.split()
                    if len(words) >= width:
                        parts.append(known.of(words))
                        ids.append(doc)
                        keys.append(key)
                        lengths.append(len(words))
            if not parts:
                continue
            lengths = np.array(lengths, "<i8")
            ids, keys = np.array(ids, "<i8"), np.array(keys, "<i8")
            hashes = mix(windows(np.concatenate(parts), width))
            # Windows that would reach into the next document don't count.
            valid = np.ones(len(hashes) + width - 1, bool)
            ends = np.cumsum(lengths)
            for back in range(1, width):
                valid[ends - back] = False
            at = np.flatnonzero(valid[:len(hashes)])
            docs = np.repeat(ids, lengths - width + 1)
            rows = list(_pack_chunk(part << 24 | number, hashes[at], at, docs, (ids, keys, lengths), buckets))
            for i in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 2000], strict=True), BLOCK, strict=True)],
                    schema=BLOCK)
    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _reduce_bucket(table: pa.Table) -> pa.Table:
    """Mark the windows of a bucket whose hash also belongs to a smaller document of any chunk."""
    out, chunks, hashes, places, ids = [], [], [], [], []
    for row in table.to_pylist():
        if row["hashes"] is None:
            out.append((row["chunk"], row["marked"], row["ids"], row["keys"], row["lengths"]))
            continue
        chunks.append(row["chunk"])
        hashes.append(_unplane(row["hashes"], HASH_BYTES))
        places.append(_unstep(row["places"]))
        ids.append(_unstep(row["ids"]))
    if hashes:
        later = _later(np.concatenate(hashes), np.concatenate(ids))
        ends = np.cumsum([len(p) for p in places])
        for chunk, place, own in zip(chunks, places, np.split(later, ends[:-1]), strict=True):
            if own.any():
                out.append((chunk, place[own].astype("<u4").tobytes(), None, None, None))
    return _batch(out, FOUND)


def _merge_chunk(width: int):
    def run(table: pa.Table) -> pa.Table:
        """Maximal intervals of each document of a chunk that marked windows cover."""
        rows = table.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        ids, keys, lengths = (np.frombuffer(head[c], "<i8") for c in ("ids", "keys", "lengths"))
        at = np.unique(np.concatenate([np.frombuffer(r["marked"], "<u4") for r in rows])).astype(np.int64)
        ends = np.cumsum(lengths)
        owner = np.searchsorted(ends, at, side="right")
        begin = at - (ends - lengths)[owner]
        first = np.append(True, (owner[1:] != owner[:-1]) | (begin[1:] > begin[:-1] + width)) if len(at) else []
        starts = np.flatnonzero(first)
        stops = begin[np.append(starts[1:], len(at)) - 1] + width if len(at) else []
        spans: dict[int, list] = {}
        for o, a, b in zip(owner[starts].tolist(), begin[starts].tolist(), list(stops), strict=True):
            spans.setdefault(o, []).append({"start": a, "end": int(b)})
        return _batch([(int(ids[o]), int(keys[o]), s) for o, s in spans.items()], SPANS)
    return run


def cut_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    kept, last = [], 0
    for span in spans:
        kept += words[last:span["start"]]
        last = span["end"]
    return kept + words[last:]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, kept = [], []
        for text, spans in zip(raw(batch.column("_text")), batch.column("removed").to_pylist(), strict=True):
            words = (text or b"").split()
            counts.append(len(words))
            kept.append(b" ".join(cut_words(words, spans or [])))
        columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_text"]
        names = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(counts, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[*names, "n_words", "kept_text"])


def find_repeats(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The intervals of words to remove: ``_id``, ``_key`` (hash of the text) and ``_spans``, for documents that have any."""
    buckets = BUCKETS_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    texts = docs.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("text"))
    blocks = texts.mapInArrow(_blocks(width, buckets), from_arrow_schema(BLOCK))
    found = blocks.groupBy("bucket").applyInArrow(_reduce_bucket, from_arrow_schema(FOUND))
    return found.groupBy("chunk").applyInArrow(_merge_chunk(width), from_arrow_schema(SPANS))


def dedup_substrings(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``removed`` (array of (start, end) in words) and ``kept_text`` (kept words, one space apart).

    Words are runs of anything but space and \\t to \\r, unchanged. A word is removed if a window over it also starts in a
    document with a smaller ``doc_id`` of the input as it was. Texts under ``width`` words, null and empty texts and rows
    without id lose nothing and cause nothing (null: no words, empty ``kept_text``). Rows of one id never remove each other's
    words, so exact repeats of a row stay alike. An empty table gives an empty result; columns of ``docs`` called like the
    added ones are replaced. Two different windows count as one if their 64-bit hashes agree.
    """
    added = ["n_words", "removed", "kept_text"]
    kept = [c for c in docs.columns if c not in added]
    spans = find_repeats(docs, width, doc_id, text).dropDuplicates(["_id", "_key"])
    rows = docs.select(*kept, F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_key"))
    joined = rows.join(spans, ["_id", "_key"], "left").select(
        *kept, F.col("_spans").alias("removed"), F.col(text).alias("_text"))
    schema = T.StructType([*joined.drop("_text").schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(_apply, schema).select(
        *kept, "n_words", F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")).alias("removed"),
        "kept_text")
