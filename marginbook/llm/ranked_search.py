"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

The index has one row per shard, a bounded run of documents. A shard holds the hashes of its terms in order, their document
counts, and posting lists cut into blocks of 64: the first document, the greatest count and the shortest document of each block in the
open, the rest of the postings in variable-length bytes. Both are enough for an upper bound of the scores in a block for any
collection, so an index is written once and searched with statistics that are summed later.

Search of a shard, query by query. Lists are taken by falling bound (weight times the best block). While documents that occur in
the remaining lists only could still enter the query's best, a list is essential and is read whole. The others are
non-essential: they only complete documents already met. Such a candidate is rejected, before anything of the list is decompressed, if its
score and the maxima of the blocks that it would lie in don't reach the last of the best; only blocks of candidates left are read. A task
keeps the best of each query from shard to shard, so bounds rise as it goes; the heaps of all tasks are merged in Spark.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from marginbook.llm.frames import groups_of, raw, shared_folder, text_bytes
from marginbook.llm.words import WordHashes

SHARD_BYTES = 16 << 20
PIECE_BYTES = 4 << 20
BLOCK = 64
#: Terms of the queries searched in one pass; the table of a pass is sent to the tasks.
PACK_TERMS = 200_000
#: Postings that a shard keeps decompressed between queries.
KEPT_POSTINGS = 4_000_000
#: Letters, digits and all beyond ASCII stay, A-Z in lower case; the rest separates terms.
TERMS = bytes(c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

INDEX = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("hashes", pa.binary()), ("dfs", pa.binary()),
                   ("ids", pa.binary()), ("named", pa.binary()), ("lengths", pa.binary()), ("firsts", pa.binary()), ("most", pa.binary()),
                   ("shortest", pa.binary()), ("gap_bytes", pa.binary()), ("count_bytes", pa.binary()), ("gaps", pa.binary()),
                   ("counts", pa.binary())])
ASKED = pa.schema([("item_id", pa.int64()), ("item_key", pa.int64()), ("hash", pa.int64()), ("times", pa.int64())])
DFS = pa.schema([("term", pa.int64()), ("df", pa.int64())])
FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, a few megabytes of it at a time."""
    plain = (text or b"").translate(TERMS)
    start = 0
    while start < len(plain):
        stop = plain.find(b" ", start + PIECE_BYTES)
        stop = len(plain) if stop < 0 else stop
        yield plain[start:stop].split()
        start = stop


def pack_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, lowest first, the high bit on all but the last; and the bytes of each value."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >= np.uint64(1) << np.uint64(bits)
        if not more.any():
            break
        sizes += more
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        own = sizes > k
        low = (values[own] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8)
        out[at[own] + k] = low | np.where(sizes[own] > k + 1, 128, 0).astype(np.uint8)
    return out, sizes


def unpack_bytes(data: np.ndarray) -> np.ndarray:
    if not len(data) or data.max() < 128:
        return data.astype(np.int64)
    starts = np.append(0, np.flatnonzero(data < 128)[:-1] + 1)
    places = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * places, starts)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def build_shard(shard: int, ids: list, lengths: list[int], hashes: list[np.ndarray]) -> tuple:
    """A row of the index, from the documents that have terms and the hashes of all their terms in order."""
    lens = np.array(lengths, np.int64)
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], np.repeat(np.arange(len(lens), dtype=np.uint32), lens)[order]
    new = np.append(True, (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])) if len(every) else np.empty(0, bool)
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(every)))
    term, doc = every[at], owner[at].astype(np.int64)
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.empty(0, np.int64)
    df = np.diff(np.append(starts, len(term)))
    first = (np.arange(len(term)) - np.repeat(starts, df)) % BLOCK == 0
    blocks = np.flatnonzero(first)
    size = np.diff(np.append(blocks, len(term)))
    gaps = np.diff(doc, prepend=0)
    gap_data, gap_sizes = pack_bytes(gaps[~first])
    # A block of one posting says all in the open.
    packed = np.repeat(size > 1, size)
    count_data, count_sizes = pack_bytes(tf[packed])

    def per_block(sizes: np.ndarray, of: np.ndarray) -> np.ndarray:
        own = np.zeros(len(term), np.int64)
        own[of] = sizes
        return np.add.reduceat(own, blocks) if len(blocks) else own

    least = np.minimum.reduceat(lens[doc], blocks) if len(blocks) else lens
    most = np.maximum.reduceat(tf, blocks) if len(blocks) else tf
    return (shard, len(lens), int(lens.sum()), term[starts].astype("<u8").tobytes(), df.astype("<u4").tobytes(),
            np.array([0 if i is None else i for i in ids], "<i8").tobytes(), np.array([i is not None for i in ids], bool).tobytes(),
            lens.astype("<i8").tobytes(), doc[blocks].astype("<u4").tobytes(), most.astype("<u4").tobytes(), least.astype("<u4").tobytes(),
            per_block(gap_sizes, ~first).astype("<u2").tobytes(), per_block(count_sizes, packed).astype("<u2").tobytes(),
            gap_data.tobytes(), count_data.tobytes())


def _index(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = WordHashes(), TaskContext.get().partitionId()
        size = text_bytes("text")
        for number, group in enumerate(groups_of(batches, lambda b: size(b) + 64, shard_bytes)):
            ids, lengths, hashes = [], [], []
            for batch in group:
                for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text")), strict=True):
                    own = [known.of(terms) for terms in term_lists(text)]
                    if n := sum(map(len, own)):
                        ids.append(doc)
                        lengths.append(n)
                        hashes += own
            if ids:
                row = build_shard(part << 24 | number, ids, lengths, hashes)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, INDEX, strict=True)], schema=INDEX)
    return run


def write_index(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all whole texts of ``docs``, written to ``path`` (which all executors see) and read again.

    A term is a run of letters, digits and characters beyond ASCII; only A-Z are lower-cased. Null and empty texts, and texts without
    terms, are in no shard and in no statistic. Every other row is a document of its own, also one that repeats or has no id. Terms are
    known by 64-bit hashes. An empty table gives an empty index.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    index = rows.mapInArrow(_index(shard_bytes), from_arrow_schema(INDEX))
    index.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


class Shard:
    """A row of the index, opened for a collection of ``documents`` that hold ``terms`` terms."""

    def __init__(self, row: dict, documents: int, terms: int):
        get = lambda name, kind: np.frombuffer(row[name], kind)
        self.hashes, self.dfs = get("hashes", "<u8"), get("dfs", "<u4").astype(np.int64)
        self.ids, self.named = get("ids", "<i8"), get("named", bool)
        # 64 bits may not hold the product of a long text and a large collection.
        self.length = lambda n: np.array([75 + 25 * v * documents // terms for v in n.tolist()], np.int64)
        self.m = self.length(get("lengths", "<i8"))
        self.firsts, self.most, self.shortest = get("firsts", "<u4").astype(np.int64), get("most", "<u4").astype(np.int64), get("shortest", "<u4")
        self.gaps, self.counts = get("gaps", np.uint8), get("counts", np.uint8)
        gap_bytes, count_bytes = get("gap_bytes", "<u2").astype(np.int64), get("count_bytes", "<u2").astype(np.int64)
        self.gap_at, self.count_at = np.append(0, np.cumsum(gap_bytes)), np.append(0, np.cumsum(count_bytes))
        per_term = -(-self.dfs // BLOCK)
        self.block_at = np.append(0, np.cumsum(per_term))
        self.opened: dict[int, tuple] = {}
        self.held = self.read = 0

    def impact(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)

    def bounds(self, term: int) -> np.ndarray:
        """An upper bound of the impacts in each block of a term: most occurrences in the shortest document."""
        own = slice(self.block_at[term], self.block_at[term + 1])
        return self.impact(self.most[own], self.length(self.shortest[own]))

    def postings(self, term: int, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts in some of a term's blocks."""
        self.read += len(picked)
        blocks = self.block_at[term] + picked
        sizes = np.where(picked == self.block_at[term + 1] - self.block_at[term] - 1, (self.dfs[term] - 1) % BLOCK + 1, BLOCK)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        doc, tf = np.empty(int(ends[-1]), np.int64), np.empty(int(ends[-1]), np.int64)
        rest = np.ones(len(doc), bool)
        rest[begins] = False
        doc[begins] = self.firsts[blocks]
        doc[rest] = unpack_bytes(self.gaps[ranges(self.gap_at[blocks], self.gap_at[blocks + 1] - self.gap_at[blocks])])
        run = np.cumsum(doc)
        doc = run - np.repeat(run[begins] - self.firsts[blocks], sizes)
        several = np.repeat(sizes > 1, sizes)
        tf[~several] = self.most[blocks[sizes == 1]]
        tf[several] = unpack_bytes(self.counts[ranges(self.count_at[blocks], self.count_at[blocks + 1] - self.count_at[blocks])])
        return doc, self.impact(tf, self.m[doc])

    def whole(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of a term, kept for the next query that reads them."""
        if (found := self.opened.get(term)) is None:
            found = self.postings(term, np.arange(self.block_at[term + 1] - self.block_at[term]))
            self.held += len(found[0])
            if self.held > KEPT_POSTINGS:
                self.opened.clear()
                self.held = len(found[0])
            self.opened[term] = found
        return found


class Best:
    """The best documents of a query so far: score, whether the id is known, id."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.nameless, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def least(self) -> int:
        """The score below which nothing enters."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, named: np.ndarray, ids: np.ndarray) -> None:
        score, nameless, ids = np.append(self.score, score), np.append(self.nameless, ~named), np.append(self.ids, ids)
        order = np.lexsort((ids, nameless, -score))[:self.top]
        self.score, self.nameless, self.ids = score[order], nameless[order], ids[order]


def search_shard(shard: Shard, lists: list[tuple[int, int]], bounds: dict[int, np.ndarray], best: Best) -> None:
    """Add a shard's documents to the best of one query; ``lists`` are its terms' places in the shard with their weights."""
    ranked = sorted(((weight * int(bounds[term].max()), weight, term) for term, weight in lists if weight > 0), reverse=True)
    left = np.append(np.cumsum([b for b, _, _ in ranked][::-1])[::-1], 0) if ranked else np.zeros(1, np.int64)
    least, essential, seen = best.least(), 0, np.empty(0, np.int64)
    total, met = np.zeros(len(shard.ids), np.int64), np.zeros(len(shard.ids), bool)
    while essential < len(ranked) and left[essential] >= least:
        _, weight, term = ranked[essential]
        docs, impacts = shard.whole(term)
        seen = np.append(seen, docs[~met[docs]])
        met[docs] = True
        total[docs] += weight * impacts
        if len(seen) >= best.top:
            least = max(least, int(np.partition(total[seen], len(seen) - best.top)[len(seen) - best.top]))
        essential += 1
    docs = seen[total[seen] + left[essential] >= least]
    score = total[docs]
    rest = []
    for _, weight, term in ranked[essential:]:
        own = slice(shard.block_at[term], shard.block_at[term + 1])
        block = np.searchsorted(shard.firsts[own], docs, side="right") - 1
        rest.append((weight, term, block, np.where(block >= 0, weight * bounds[term][block], 0)))
    hope = score + sum((b for *_, b in rest), np.zeros(len(docs), np.int64))
    alive = hope >= least
    for weight, term, block, bound in rest:
        open_ = np.flatnonzero(alive & (block >= 0))
        if not len(open_):
            continue
        found, impacts = shard.postings(term, np.unique(block[open_]))
        at = np.minimum(np.searchsorted(found, docs[open_]), len(found) - 1)
        gain = np.where(found[at] == docs[open_], weight * impacts[at], 0)
        score[open_] += gain
        hope[open_] += gain - bound[open_]
        alive &= hope >= least
    docs, score = docs[alive], score[alive]
    best.add(score, shard.named[docs], shard.ids[docs])


def _search(hashes: np.ndarray, weights: np.ndarray, asked: list[tuple[np.ndarray, np.ndarray]], documents: int, terms: int, top: int):
    """Tasks that search their shards for all queries of a pass: places in ``hashes`` and repeats of each query's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], documents, terms)
                places = np.minimum(np.searchsorted(shard.hashes, hashes), len(shard.hashes) - 1)
                present = shard.hashes[places] == hashes
                bounds = {int(t): shard.bounds(int(t)) for t in places[present & (weights > 0)]}
                for own, (ranks, times) in zip(best, asked, strict=True):
                    there = present[ranks]
                    lists = zip(places[ranks[there]].tolist(), (weights[ranks] * times)[there].tolist(), strict=True)
                    search_shard(shard, list(lists), bounds, own)
        sizes = [len(b.score) for b in best]
        if sum(sizes):
            ids, nameless = np.concatenate([b.ids for b in best]), np.concatenate([b.nameless for b in best])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(ids, pa.int64(), mask=nameless),
                                              pa.array(np.concatenate([b.score for b in best]))], schema=FOUND)
    return run


def _sum_dfs(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for theirs, dfs in zip(batch.column("hashes").to_pylist(), batch.column("dfs").to_pylist(), strict=True):
                theirs, dfs = np.frombuffer(theirs, "<u8"), np.frombuffer(dfs, "<u4")
                places = np.minimum(np.searchsorted(theirs, hashes), len(theirs) - 1)
                sums += np.where(theirs[places] == hashes, dfs[places], 0)
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], schema=DFS)
    return run


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        rows = []
        for item, key, text in zip(batch.column("item_id").to_pylist(), batch.column("item_key").to_pylist(), raw(batch.column("text")), strict=True):
            counts = Counter(h for terms in term_lists(text) for h in known.of(terms).view(np.int64).tolist())
            rows += [(item, key, h, n) for h, n in counts.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(ASKED)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ASKED, strict=True)], schema=ASKED)


def search_index(index: DataFrame, items: DataFrame, path: str, top: int = 20, item_id: str = "item_id", text: str = "text",
                 pack_terms: int = PACK_TERMS) -> DataFrame:
    """The ``top`` documents of the index for each item: ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` above 0.

    With N documents, L terms in all, n terms in a document and df documents that hold a term, a term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``, and an item's term, once for each time it repeats, adds its weight times
    ``10^9 tf div (1000 tf + 12 m)`` with ``m = 75 + 25 n N div L``. Equal scores go by ascending ``doc_id``, unknown ids last. Rows
    alike in id and text are one item; rows that share an id with other texts are ranked each by itself. Null texts and
    texts without terms find nothing. An empty index or no items give an empty result. Further columns are ignored.

    Items are searched in passes of about ``pack_terms`` terms. A pass holds only its own terms on the driver and writes its best to
    ``path``, a folder that all executors see, before the next one begins.
    """
    spark: SparkSession = index.sparkSession
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.dropDuplicates(["item_id", "text"]).select("item_id", F.xxhash64("text").alias("item_key"), "text")
    rows.mapInArrow(_ask, from_arrow_schema(ASKED)).write.mode("overwrite").parquet(f"{path}/asked")
    asked = spark.read.schema(from_arrow_schema(ASKED)).parquet(f"{path}/asked")
    documents, terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    passes = -(-asked.count() // pack_terms) if documents else 0
    schema = from_arrow_schema(pa.schema([ASKED.field("item_id"), ASKED.field("item_key"), *list(FOUND)[1:]]))
    for number in range(passes):
        own = asked.where(F.pmod(F.xxhash64("item_id", "item_key"), F.lit(passes)) == number).toPandas()
        if len(own):
            _pass(index, own, documents, terms, top).write.mode("overwrite").parquet(f"{path}/found/pass={number}")
    heaps = spark.read.schema(schema).parquet(f"{path}/found") if passes else spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id", "item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _pass(index: DataFrame, own, documents: int, terms: int, top: int) -> DataFrame:
    """The best of every task for the items of one pass (a pandas frame of ``ASKED``)."""
    spark = index.sparkSession
    hashes, ranks = np.unique(own["hash"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    dfs = np.zeros(len(hashes), np.int64)
    sums = index.select("hashes", "dfs").mapInArrow(_sum_dfs(hashes), from_arrow_schema(DFS)).groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in sums.collect():
        dfs[term] = df
    weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * int(df) + 1))) for df in dfs], np.int64)
    times = own["times"].to_numpy(np.int64)
    numbers = own.groupby(["item_id", "item_key"], dropna=False).indices
    asked = [(ranks[i], times[i]) for i in numbers.values()]
    names = spark.createDataFrame([(n, None if k[0] != k[0] else int(k[0]), int(k[1])) for n, k in enumerate(numbers)],
                                  "item long, item_id long, item_key long")
    found = index.mapInArrow(_search(hashes, weights, asked, documents, terms, top), from_arrow_schema(FOUND))
    return found.join(names, "item").select("item_id", "item_key", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """``search_index`` over an index written for the occasion to the shared folder."""
    path = f"{shared_folder(docs.sparkSession)}/lexical-{uuid.uuid4().hex}"
    return search_index(write_index(docs, f"{path}/index"), items, path, top)
