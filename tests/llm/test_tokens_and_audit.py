"""Token counts against the library over whole texts, and the filter audit against each order run by itself."""

import random
import re
from collections import defaultdict
from itertools import permutations

import public_tokenizers
import pytest
import sentencepiece

from marginbook.llm import filter_audit, queries, token_counts

from . import brute

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    kinds = ["a", " ", "ab", "\n", "\t ", "日本語", "é", "😀", "Straße", "<s>", "</s>", "<0x0A>", "▁", "\x00", "0", "http", "ing", "tion ", "  the", "́"]
    made = ["".join(rng.choice(kinds) * rng.choice((1, 1, 1, 2, 7, 40)) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    runs = [c * 3_000 for c in ("a", " ", "=", "😀", "日", "\n", "ab", "aab", "▁", "\x00")]
    return ["", " ", "x", *made, *runs, " ".join(r[0] or "" for r in queries.table(spark, SF, "documents").select("text").limit(40).collect())]


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 256), (200, 20), (40, 3), (7, 1)])
def test_spliced_counts_are_those_of_the_whole_text(texts, library, chunk, overlap):
    encoder, widened = token_counts.Encoder(open(MODEL, "rb").read()), 0
    for text in texts:
        if len(text) > chunk:
            count, again = encoder.count_long(text, chunk, overlap)
            assert count == len(library.encode(text)), (text[:60], len(text))
            widened += again
    assert widened > 0 or overlap >= 20


def test_token_counts(spark, library):
    docs = [(r[0], r[1]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op12_token_counts(spark, SF).collect()}
    want = {d: (len((t or "").encode()), n, n > 4096) for (d, t), n in zip(docs, map(len, library.encode([t or "" for _, t in docs])), strict=True)}
    assert got == want and any(len(t or "") > token_counts.CHUNK for _, t in docs)


def test_token_counts_of_odd_rows(spark, odd_documents, library):
    rows = token_counts.count_tokens(odd_documents.withColumnRenamed("size", "n_tokens"), MODEL, limit=3, chunk=1000, overlap=10).collect()
    assert len(rows) == odd_documents.count()
    want = sorted((str(r.doc_id), len(library.encode(r.text or "")), len((r.text or "").encode())) for r in odd_documents.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.n_bytes) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 3) for r in rows) and "lang" in rows[0]
    assert token_counts.count_tokens(odd_documents.limit(0), MODEL).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(odd_documents, MODEL, overlap=0)


def brute_audit(docs, labels):
    """(part, order, step) to the counts, each order run over the documents one by one."""
    least, good, toxic = {}, {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    rows = []
    for doc, text, part in docs:
        t = text or ""
        w = brute.words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": doc is not None and least[t] < doc}
        rows.append((part or "", {f for f in fails if fails[f]}, doc in good, doc in toxic))
    out, shapley = {}, defaultdict(int)
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = (len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, f] += len(gone)
    return {k: v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def audited(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_filter_audit(spark):
    docs = [(r.doc_id, r.text, r.source) for r in queries.table(spark, SF, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in queries.table(spark, SF, "labels").collect()]
    got = audited(queries.op13_filter_audit(spark, SF))
    assert got == brute_audit(docs, labels) and len(got) == 600 * len({d[2] for d in docs})


def test_filter_audit_of_odd_rows(spark, odd_documents):
    shout = " ".join(["LOUD $"] * 150)
    rows = [(r.doc_id, r.text, r.source) for r in odd_documents.collect()]
    rows += [(None, shout, None), (None, shout, None), (50, shout, "a"), (51, shout, ""), (51, shout, "b"), (-3, shout, "c"), (52, "", "a")]
    marks = [(1, 1, 0), (1, 0, 1), (1, 1, 0), (51, 0, 1), (None, 1, 1), (50, None, None), (99, 1, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, part string, mask int")
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, text string")
    assert audited(filter_audit.audit_documents(df, labels)) == brute_audit(rows, marks)
    assert filter_audit.audit_documents(df.limit(0), labels).count() == 0
    assert audited(filter_audit.audit_documents(df, labels.limit(0))) == brute_audit(rows, [])


def test_paths_through_the_lattice():
    reach, leave = filter_audit.forward_counts(4), filter_audit.backward_counts(4)
    assert reach[15] == leave[0] == 24 and reach[0] == leave[15] == 1 and reach[7] == 6 and leave[1] == 6
    assert all(sum(reach[s] * leave[s | 1 << f] for s in range(16) if not s >> f & 1) == 24 for f in range(4))


def test_audit_of_other_filters(spark):
    counts = spark.createDataFrame([("p", 3, 5), ("p", 1, 2), ("p", 0, 1)], "part string, mask int, n long")
    got = audited(filter_audit.audit_orders(counts, "XY"))
    assert got == {("p", "XY", 1): (1, 7, 0, 2, 12 - 3), ("p", "XY", 2): (1, 0, 5, 0, 5), ("p", "YX", 1): (3, 5, 0, 0, 5), ("p", "YX", 2): (1, 2, 5, 2, 9)}
    with pytest.raises(ValueError):
        filter_audit.audit_orders(counts, "ABCDEFGH")
