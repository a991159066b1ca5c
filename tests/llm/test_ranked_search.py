"""Ranked search against a plain scoring of every document."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from marginbook.llm import queries, ranked_search

from . import brute

SF = "/root/testdata/sf0.001"


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text))


def ranked(docs, items, top=20):
    """(item, rank) to (doc, score) for (id, text) rows; ids of items are distinct."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n, total = len(counts), sum(x for *_, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = {}
    for item, text in items:
        asked = Counter(terms_of(text))
        scored = []
        for doc, c, size in counts:
            m = 75 + 25 * size * n // total
            score = sum(k * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(scored, key=lambda r: r[:3])[:top], 1):
            out[item, rank] = (doc, -s)
    return out


def got(df):
    rows = df.collect()
    found = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def tables(spark):
    return [[(r[0], r[1]) for r in queries.table(spark, SF, n).select(i, "text").collect()] for n, i in (("documents", "doc_id"), ("benchmark", "item_id"))]


def test_ranked_search(spark, tables):
    assert got(queries.op11_ranked_search(spark, SF)) == ranked(*tables)


@pytest.mark.parametrize(("shard", "pack", "top"), [(1 << 30, 100_000, 20), (40_000, 40, 3), (1, 500, 1)])
def test_shards_and_passes(spark, tables, tmp_path, shard, pack, top):
    docs, items = tables
    rng = random.Random(1)
    common = [f"c{i}" for i in range(40)]
    docs = docs + [(10_000 + i, " ".join(rng.choices(common, k=rng.randrange(1, 60)) + [f"r{rng.randrange(200)}"] * rng.randrange(3))) for i in range(1500)]
    items = items + [(900 + i, " ".join(rng.choices(common, k=6) + [f"r{i}", f"r{i}", "absent"])) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = ranked_search.write_index(df, f"{tmp_path}/index", shard_bytes=shard)
    found = ranked_search.search_index(index, spark.createDataFrame(items, "item_id long, text string"), f"{tmp_path}/work", top, pack_terms=pack)
    assert got(found) == ranked(docs, items, top)


def test_blocks_are_skipped():
    """With a strong lead, blocks of the common terms stay closed but for the candidates' own."""
    rng = np.random.default_rng(0)
    lengths = rng.integers(20, 40, 20_000)
    owners = np.repeat(np.arange(20_000), lengths)
    hashes = rng.integers(1, 30, len(owners)).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    for rare, doc in enumerate(rng.permutation(20_000)[:25]):
        hashes[starts[doc]] = 1_000
    row = ranked_search.build_shard(0, list(range(20_000)), lengths.tolist(), np.split(hashes, starts[1:]))
    shard = ranked_search.Shard(dict(zip(ranked_search.INDEX.names, row, strict=True)), 20_000, int(lengths.sum()))
    weights = [floor(1000 * log(40_002 / (2 * int(d) + 1))) for d in shard.dfs]
    lists = [(t, weights[t]) for t in (*range(1, 8), len(shard.hashes) - 1)]
    best = ranked_search.Best(20)
    ranked_search.search_shard(shard, lists, {t: shard.bounds(t) for t, _ in lists}, best)
    assert shard.read < 0.2 * sum(shard.block_at[t + 1] - shard.block_at[t] for t, _ in lists)
    every = np.zeros(20_000, np.int64)
    for t, w in lists:
        docs, impacts = shard.whole(t)
        every[docs] += w * impacts
        assert (impacts <= np.repeat(shard.bounds(t), 64)[:len(impacts)]).all() and len(docs) == shard.dfs[t]
    want = sorted(zip((-every).tolist(), range(20_000)))[:20]
    assert [(-s, d) for s, d in zip(best.score.tolist(), best.ids.tolist())] == want


def test_bytes_round_trip():
    values = np.array([0, 1, 127, 128, 300, 16_383, 16_384, 2**21, 2**40, 2**62, 5])
    data, sizes = ranked_search.pack_bytes(values)
    assert (ranked_search.unpack_bytes(data) == values).all() and sizes.sum() == len(data)
    assert len(ranked_search.unpack_bytes(ranked_search.pack_bytes(values[:0])[0])) == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(ranked_search, "PIECE_BYTES", 5)
    text = "Abc dé-f  ghi\x00jklmnopqrstuvw 1 "
    assert [t.decode() for p in ranked_search.term_lists(text.encode()) for t in p] == terms_of(text)


def test_odd_rows(spark, odd_documents, tmp_path):
    df = odd_documents.withColumnRenamed("size", "score").withColumnRenamed("source", "rank")
    items = [(1, "same1 SAME2 one"), (1, "same1 SAME2 one"), (2, None), (3, ""), (4, "straße w5"), (None, "one one"), (5, "nowhere")]
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id long")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked_search.rank_documents(df, asked).collect()), key=str)
    want = ranked(docs, [i for k, i in enumerate(items) if k != 1])
    assert found == sorted(((i, k, d, s) for (i, k), (d, s) in want.items()), key=str) and {r[2] for r in found if r[0] == 1} == {1, 2, None, 9}
    assert ranked_search.rank_documents(df.limit(0), asked).count() == 0 and ranked_search.rank_documents(df, asked.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "one"), (1, "one w5")], "item_id long, text string")
    assert sorted((r.item_id, r["rank"]) for r in ranked_search.rank_documents(df, twice).collect()) == [(1, 1), (1, 1), (1, 2), (1, 3)]
