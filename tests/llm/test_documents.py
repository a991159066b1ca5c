"""Operators over documents against plain restatements, and on odd rows."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from marginbook.llm import decontaminate, jaccard, mixing, queries, substrings, suffix_model
from pyspark.sql import functions as F

import corpus_pipeline

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r[0], r[1]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]


def near_copies():
    rng, out = random.Random(3), []
    for size, copies in ((150, 60), (500, 12)):
        base = [f"b{rng.randrange(9999)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(size // 25)):
                words[rng.randrange(size)] = f"x{rng.randrange(99999)}"
            out.append((10_000 + len(out), " ".join(words)))
    return out


@pytest.mark.parametrize(("rare", "cell", "width", "percent"), [(32, 256, 3, 90), (2, 4, 5, 80), (2, 8, 3, 60)])
def test_jaccard_classes(spark, docs, monkeypatch, rare, cell, width, percent):
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "CELL", cell)
    rows = docs + near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in jaccard.jaccard_classes(df, width, percent).collect()}
    assert got == brute.classes(rows, width, percent)


def test_jaccard_deals_few_texts_and_pairs(spark, monkeypatch):
    """Of a small group of near copies each set is compared a few times, not once a pair, and other texts aren't dealt."""
    rng, dealt = random.Random(5), []
    base = [f"b{i}" for i in range(200)]
    copies = [(k, " ".join([*base[:90], f"x{k}", *base[91:]])) for k in range(30)]
    rows = copies + [(100 + k, " ".join(f"{k}w{rng.randrange(9999)}" for _ in range(200))) for k in range(60)]
    hold, full, keep = jaccard._hold, jaccard._full_sets, jaccard.Scratch.keep
    accumulators = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counting(run, count):
        def counted(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield from run(iter([batch]))
        return counted
    monkeypatch.setattr(jaccard, "_hold", lambda rule: counting(hold(rule), accumulators[0]))
    monkeypatch.setattr(jaccard, "_full_sets", lambda width: counting(full(width), accumulators[1]))

    def kept(self, name, df):
        out = keep(self, name, df)
        if name == "full":
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/sets")
            dealt.append(path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path))
        return out
    monkeypatch.setattr(jaccard.Scratch, "keep", kept)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in jaccard.jaccard_classes(df, 5, 80).collect()}
    assert got == brute.classes(rows, 5, 80)
    assert 29 <= accumulators[0].value <= 60  # 435 pairs
    assert accumulators[1].value == 30 and dealt == [False]  # the prefixes are gone by then


def test_short_sets_lose_no_pair(spark):
    rng, rule = random.Random(6), jaccard.Rule(80)
    sets, pairs = [], []
    for k in range(60):
        n = rng.choice((5, 40, 3000))
        a = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)]
        b = a[:n - rng.randrange(n // 3 + 1)] + [rng.randrange(-(1 << 63), 1 << 63) for _ in range(rng.randrange(n // 8 + 1))]
        sets += [(2 * k, True, np.array(sorted(a)).tobytes()), (2 * k + 1, True, np.array(sorted(b)).tobytes())]
        pairs += [(2 * k, 2 * k + 1), (2 * k, 2 * rng.randrange(k + 1) + 1)]
    full = spark.createDataFrame(sets, "sid long, paired boolean, tokens binary")
    frame = spark.createDataFrame(pairs, "a long, b long")
    near = {tuple(r) for r in jaccard._near(frame, full, rule).collect()}
    similar = {tuple(r) for r in jaccard._compared(frame, full, rule).collect()}
    assert 20 < len(similar) and similar <= near and len(near) < len(set(pairs)) - 10


@pytest.mark.parametrize("percent", [75, 80, 90, 95])
def test_two_similar_sets_share_a_combination(percent):
    rng, rule = random.Random(percent), jaccard.Rule(percent)
    assert rule.combines() and not jaccard.Rule(60).combines()
    for _ in range(2000):
        n = rng.randrange(rule.least(), 90)
        universe = rng.sample(range(10_000), n + n // 3 + 1)
        a = set(universe[:n])
        b = set(rng.sample(sorted(a), n - rng.randrange(rule.spare(n) + 1))) | set(universe[n:n + rng.randrange(n // 3 + 1)])
        if not rule.holds(len(a & b), len(a), len(b)):
            continue
        found = []
        for one in (sorted(a), sorted(b)):
            prefix = one[:rule.kept(len(one))]
            found.append(set(zip(prefix, prefix[1:rule.broken(len(one)) + 2], strict=False)))
        assert found[0] & found[1]


def test_substrings(spark, docs):
    got = {r[0]: tuple(r)[1:] for r in queries.op8_substring_dedup(spark, SF).collect()}
    assert got == brute.substrings(docs)


def test_leaks(spark, docs):
    items = [(r[0], r[1]) for r in queries.table(spark, SF, "benchmark").collect()]
    got = {r[0]: tuple(r)[1:5] for r in queries.op5_decontamination(spark, SF).collect()}
    assert got == brute.leaks(docs, items)


def test_short_items_and_slices(spark):
    docs = [(1, "a Bb c d e f g h i j k l x"), (2, "bb-C! d"), (3, "l"), (4, None), (5, "")]
    items = [(1, "A bb c d e f g h i j k l"), (2, "bb c"), (3, None), (4, "..."), (None, "x"), (5, "bb c")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(docs, [i for i in items if i[0] is not None])
    for words in (2_000_000, 1):  # one slice, and several
        rows = decontaminate.decontaminate(d, b, phrase_words=words).collect()
        got = {r.doc_id: (r.n_words, sum(s["end"] - s["start"] for s in r.spans), len(r["items"]), brute.sha(",".join(map(str, r["items"])))) for r in rows}
        assert got == want
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(decontaminate.decontaminate(d, b)).collect()}
    assert cut == {1: " x", 2: "! d".replace("!", "!"), 3: "l", 4: None, 5: ""}
    assert decontaminate.decontaminate(d, b.limit(0)).where("size(spans) > 0").count() == 0


def test_leaks_with_clashing_columns(spark):
    """Columns named like the added ones are replaced, repeated rows stay, over one slice and several."""
    rows = [(1, "a b c", "s", "i", 9), (1, "a b c", "s", "i", 9), (None, "b c d e", None, None, None), (2, None, "", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, items string, n_words int")
    b = spark.createDataFrame([(4, "B c"), (4, "b c"), (5, "e")], "item_id long, text string")
    for words in (500_000, 1):
        out = decontaminate.decontaminate(df, b, phrase_words=words)
        got = sorted((r.doc_id or 0, r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in out.collect())
        assert out.columns == ["doc_id", "text", "n_words", "spans", "items"]
        assert got == [(0, 4, [(0, 2), (3, 4)], [4, 5]), (1, 3, [(1, 3)], [4]), (1, 3, [(1, 3)], [4]), (2, 0, [], [])]


def test_mix_of_rows_without_id(spark):
    """Rows without id are ordered by their text, so reruns agree row by row and totals meet the targets."""
    rows = [(None, f"w{i} " * (i % 7 + 1), "s" if i % 3 else None) for i in range(300)] + [(None, None, "s"), (1, "one two", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [sorted((r.text or "", r.taken) for r in mixing.mix_sources(df.repartition(n)).collect()) for n in (2, 5)]
    assert taken[0] == taken[1]
    for r in mixing.mix_sources(df).groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect():
        assert r.taken == round(r.target)


def test_items_without_id(spark, tmp_path):
    """Their words are hit and cut, and only the list of ids leaves them out."""
    docs = [(1, "a Bb c x d"), (2, "c x"), (3, "Bb c")]
    spark.createDataFrame([(None, "bb c x"), (None, "d"), (7, "bb c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:4] + (r.contaminated,) for r in queries.op5_decontamination(spark, str(tmp_path)).collect()}
    assert got == {1: (5, 4, 1, True), 2: (2, 0, 0, False), 3: (2, 2, 1, True)}
    left = corpus_pipeline.cut_benchmark(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id: r.text for r in left.collect()} == {1: "a ", 2: "c x"}


def test_language_model_base(spark, docs):
    counts, ends = Counter(), 0
    for doc, text in docs:
        if zlib.crc32(str(doc).encode()) % 10:
            counts.update(brute.words(brute.lower(text)))
            ends += 1
    total = sum(counts.values()) + ends
    scale = log10(total + 0.1 * (len(counts) + 2))
    rows = {r.doc_id: r for r in queries.op6_lm_score(spark, SF).collect()}
    assert len(rows) == len(docs)
    for doc, text in docs:
        words, r = brute.words(brute.lower(text)), rows[doc]
        base = sum(log10(counts[w] + 0.1) - scale for w in words) + log10(ends + 0.1) - scale
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_of_the_model_are_joined(spark, docs, monkeypatch):
    def scores():
        return {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in queries.op6_lm_score(spark, SF).collect()}
    want = scores()
    monkeypatch.setattr(suffix_model, "WORDS_MOST", 50)
    assert scores() == want


def test_language_model_of_all_contexts(spark, monkeypatch):
    """Any word may be in a state, whatever its rank, and every context that is used often enough is tested."""
    rows = [(i, " ".join(f"{a}{(i * 7 + j * 3) % 700 if a == 'x' else (i * 7 + j * 3 - 3) % 700}" for j in range(60) for a in "xy")) for i in range(400)]
    rows += [(1000 + i, "again again x1 x1 x1 y1") for i in range(80)] + [(2000 + i, t) for i, t in enumerate(["", None, "new x5 y2 y2", "new"])]
    want = brute.suffix_tree([t for i, t in rows if i % 10], [t for _, t in rows], 3, 30, 20.0)
    assert want["states"] > 900
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in (1_000_000, 200):  # all strings sent, and most of them joined
        monkeypatch.setattr(suffix_model, "STRINGS_MOST", most)
        got = {r.doc_id: r.score for r in suffix_model.score_texts(df, F.col("doc_id") % 10 != 0).collect()}
        assert len(got) == len(rows)
        for (doc, _), score in zip(rows, want["scores"]):
            assert abs(got[doc] - score) < 1e-9 * max(1, abs(score)), (doc, got[doc], score)


def test_language_model_in_parts(spark, monkeypatch, tmp_path):
    """The tree is grown and scored in parts and blocks, and the tables of the parts go."""
    rows = [(i, " ".join(f"w{(i * i + j * (3 + i % 4)) % 60}" for j in range(50)) + " echo echo echo") for i in range(300)]
    rows += [(None, "w1 w2 w2 w3"), (7, "w1 w1"), (900, ""), (901, None), (910, "new w1 new")]
    want = brute.suffix_tree([t for i, t in rows if i is not None and i % 10], [t for _, t in rows], 3, 30, 20.0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        for name, value in (("PART", 4000), ("CELL", 100)):
            monkeypatch.setattr(suffix_model, name, value)
        got = suffix_model.score_texts(df, F.col("doc_id") % 10 != 0).collect()
        left = {p.name for p in tmp_path.rglob("scratch-*/*")}
    finally:
        spark.sparkContext.setCheckpointDir(folder)
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    pairs = zip(sorted(((r.doc_id, r.score) for r in got), key=order), sorted(zip([i for i, _ in rows], want["scores"]), key=order), strict=True)
    assert all(a == b and abs(x - y) < 1e-9 * max(1, abs(y)) for (a, x), (b, y) in pairs)
    assert {"more0", "more1", "scored"} <= left and not {n for n in left if n.startswith(("places", "chunks", "rare", "often"))}


def test_repeats_of_words_are_dealt(monkeypatch):
    """A word once more is no key of its own: after different words it goes to different tasks."""
    words = [f"w{i}" for i in range(200) for _ in range(2)] + ["on"] * 100_000
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(words)], "learn": [True]})
    packed = next(suffix_model._pack(iter([batch])))
    packed = packed.append_column("chunk", pa.array([0]))
    every = [np.full(1 << 21, 0xFFFFFFFF, np.uint32)] * 3
    shared = type("Shared", (), {"value": (every, (np.empty(0, np.uint64), np.empty(0, np.int64)))})
    dealt = {}
    for rows in suffix_model._deal_places(shared, 0, 1, 8)(iter([packed])):
        for bucket, n, data in zip(*(rows.column(c).to_pylist() for c in ("bucket", "n1", "data"))):
            own = np.frombuffer(data, np.uint64, n)
            dealt[bucket] = int((own == np.uint64(suffix_model.AGAIN)).sum())
    assert 200 < sum(dealt.values()) < 210 and max(dealt.values()) < 60  # the places of a long run are one


def test_places_of_a_context_are_dealt_together():
    """However many buckets there are, a context has one, or as many as the cells of its last word, where that is frequent."""
    text = " ".join(f"{a} w{i}" for i in range(500) for a in ("often", f"x{i % 7}"))
    packed = next(suffix_model._pack(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text], "learn": [True]})])))
    packed = packed.append_column("chunk", pa.array([0]))
    word = lambda w: xxhash.xxh3_64_intdigest(w.encode())
    every = [np.full(1 << 21, 0xFFFFFFFF, np.uint32)] * 3
    shared = type("Shared", (), {"value": (every, (np.array([word("often")], np.uint64), np.array([3])))})
    found = {}
    for rows in suffix_model._deal_places(shared, 0, 1, 64)(iter([packed])):
        for bucket, n, data in zip(*(rows.column(c).to_pylist() for c in ("bucket", "n1", "data"))):
            for before in np.frombuffer(data, np.uint64, n, 8 * n).tolist():
                found.setdefault(before, Counter())[bucket] += 1
    assert sum(sum(c.values()) for c in found.values()) == 2001
    for i in range(7):
        assert len(found[word(f"x{i}")]) == 1 and max(found[word(f"x{i}")]) < 64
    assert len(found[word("often")]) == 3 and min(found[word("often")]) >= 64 and sum(found[word("often")].values()) == 500


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_packed_texts(kind):
    """Words are split at ASCII space and told apart without the case of A to Z, as bytes; nulls and texts of spaces have none."""
    texts = ["", None, " \t\n\x0b\f\r ", "A a\u00c9 \u00e9\u00a0b\u2003c \x1c\x1fd ", "one"]
    hashes, place, sizes = suffix_model._words(pa.array(texts, kind))
    want = [brute.words(brute.lower(t or "")) for t in texts]
    assert sizes.tolist() == [len(w) for w in want] == [0, 0, 0, 4, 1]
    assert hashes[place].tolist() == [xxhash.xxh3_64_intdigest(w.encode() if isinstance(w, str) else w) for ws in want for w in ws]


def test_odd_documents(spark, odd_documents):
    n = odd_documents.count()
    cut = {(r.doc_id, r.text): r for r in substrings.dedup_substrings(odd_documents).collect()}
    same = next(t for d, t in cut if d == 1)
    assert cut[(1, same)].kept_text == same and cut[(2, same)].kept_text == "" and cut[(None, same)].kept_text == same
    assert cut[(3, None)].n_words == 0 and cut[(3, None)].kept_text == "" and cut[(7, next(t for d, t in cut if d == 7))].kept_text == "end"
    classes = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(odd_documents).collect()}
    assert {(1, 76, 1), (2, 76, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 76, None), (9, 1, 9)} <= classes
    assert {c for d, _, c in classes if d == 7} == {6}
    scored = suffix_model.score_texts(odd_documents, F.lit(True)).collect()
    assert len(scored) == n and all(r.n_tokens == 1 for r in scored if r.doc_id in (3, 4, 5))
    mixed = mixing.mix_sources(odd_documents).collect()
    assert len(mixed) == n and {r.doc_id: r["size"] for r in mixed}[3] == 0
    for part in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == part]
        assert sum(r.taken for r in own) == round(own[0].target) and all(r.taken <= 3 * r["size"] for r in own)
    leaks = decontaminate.decontaminate(odd_documents, spark.createDataFrame([(1, "same1 same2")], "item_id long, text string"))
    assert {r.doc_id for r in leaks.where("size(spans) > 0").collect()} == {1, 2, None} and "size" in leaks.columns


def test_empty_documents(spark, odd_documents):
    none = odd_documents.limit(0)
    assert substrings.dedup_substrings(none).count() == 0 and jaccard.jaccard_classes(none).count() == 0
    assert mixing.mix_sources(none).count() == 0 and suffix_model.score_texts(none, F.lit(True)).count() == 0
    assert decontaminate.decontaminate(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
