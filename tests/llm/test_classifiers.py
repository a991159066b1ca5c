"""Learnt operators by what they get right on rows kept back, and on odd rows."""

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from marginbook.llm import neardup, quality, queries, toxicity, url_labels, urls

SF = "/root/testdata/sf0.01"


def shares(spark, df, label):
    truth = {r[0]: r[1] for r in queries.table(spark, SF, "labels").select("doc_id", label).collect()}
    rows = [(r.predicted, truth[r.doc_id]) for r in df.collect() if r.held_out and r.doc_id in truth]
    return [sum(p for p, t in rows if t == k) / max(1, sum(t == k for _, t in rows)) for k in (0, 1)]


def test_quality_on_held_out_rows(spark):
    junk, good = shares(spark, queries.op7_quality(spark, SF), "quality")
    assert junk < 0.2 and good > 0.95


def test_toxicity_shares_ngrams_and_spares_clean_texts(spark):
    words = ["stupid", "moron", "idiot", "worthless"]
    clean = [f"a calm text about number {i} and the weather of day {i % 7}" for i in range(120)]
    rude = [f"{t} you {words[i % 4]} {words[(i + 1) % 4]}" for i, t in enumerate(clean)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + rude)] + [
        (1000, "what a stupidd and worthlesss thing"), (1001, "the weather of a calm day"), (1002, None), (1003, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(240)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert got[1000] > 0.7 > 0.5 > got[1001] and got[1002] == got[1003]
    assert {r.score for r in toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}


def test_quality_without_labels_or_text(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score_quality(odd_documents, none).collect()
    assert len(rows) == odd_documents.count() and {r.score for r in rows} == {0.5}
    assert quality.score_quality(odd_documents.limit(0), none).count() == 0


def test_near_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.42]), (4, [0.0, 2.0]), (5, [1.0, 0.0]), (6, None), (7, [0.0, 0.0]),
            (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, []), (12, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (13, [1e30, 1e29])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: tuple(r)[1:] for r in neardup.near_vectors(df).collect()}
    # 2 and 13 point the same way; 3 is near 2 and 13, not near 1 and 5.
    assert got[1] == (3, 1, True) and got[5] == (3, 1, False) and got[2] == (4, 1, False) and got[3][1:] == (1, False)
    assert all(got[k] == (0, k, True) for k in (4, 6, 7, 8, 9, 10, 11, 12)) and got[None] == (0, None, False)
    assert neardup.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_against_all_pairs(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 32))
    near = base[:100] + 0.3 * rng.standard_normal((100, 32))
    e = np.concatenate([base, near, base[:5]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "vec_id long, embedding array<double>")
    u = e / np.linalg.norm(e, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in neardup.near_vectors(df).collect()}
    assert [got[i] for i in range(len(e))] == want.tolist() and want.sum() > 50


def test_url_rules_and_scores(spark):
    given = [(1, "https://WWW.Example.com/en/a?q#x"), (2, "http://example.com/en/b"), (3, "https://a.example.com/en/"), (4, "x://host.com"),
             (5, "https://b.net/es/1"), (6, "https://b.net/de/1"), (7, None), (8, "no scheme"), (9, "://"), (10, "http://com/a://b/c?d")]
    df = spark.createDataFrame(given, "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, queries.URL_RULES, url_labels.labelled_urls(spark)).collect()}
    assert got[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/en/b", "example.com/en/", "block") and got[3][2:] == ("example.com/en/", "block")
    assert got[4] == ("host.com", "", None, got[4][3]) and got[5][2:] == ("net/es/", "block") and got[6][2] is None
    assert got[7][:3] == got[8][:3] == got[9][:3] == ("", "", None) and got[10] == ("com", "/a://b/c", "com/", "allow")
    assert urls.filter_urls(df.limit(0), queries.URL_RULES, url_labels.labelled_urls(spark)).count() == 0


def test_urls_by_restated_rules_and_regression(spark):
    """Every row of the pages: rules by comparing strings, and the logistic score summed n-gram by n-gram."""
    weights = urls.fit_urls(url_labels.labelled_urls(spark))
    pages = {r.page_id: r.url for r in queries.table(spark, SF, "pages").select("page_id", "url").collect()}
    rows = queries.op2_url_filter(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        rest = (pages[r.page_id] or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(p), what, p) for what, p in queries.URL_RULES
                if ("." + host).endswith("." + p.split("/", 1)[0]) and path.startswith("/" + p.split("/", 1)[1])]
        total, found = weights[-1], set()
        for mark, text in (("h", f"^{host}$"), ("p", f"{path}$")):
            for n in urls.GRAMS:
                for i in range(len(text) - n + 1):
                    found.add(xxhash.xxh3_64_intdigest(mark + text[i:i + n], n) % urls.BUCKETS)
        for bucket in found:
            total += weights[bucket]
        score = 1 / (1 + math.exp(-total / math.sqrt(len(found) + 1)))
        want = max(fits)[1] if fits else "allow" if score >= queries.BLOCKED_BELOW else "block"
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[2] if fits else None)
        assert abs(r.score - score) < 1e-9 and r.verdict == want


def test_urls_kept_back(spark):
    weights = urls.fit_urls(url_labels.labelled_urls(spark))

    def score(url):
        host, slash, path = url.partition("/")
        at = np.append(urls._features(host, slash + path), urls.BUCKETS)
        return 1 / (1 + math.exp(-weights[at].sum() / math.sqrt(len(at))))
    good = ["university.sample.org/courses/physics", "wiki.sample.net/page/lake", "news.sample.org/article/flood", "docs.sample.net/manual/usage.html"]
    bad = ["casino-royal.sample.org/slots/bonus", "best-pills.sample.net/buy/order", "porn-videos.sample.org/hot", "cracked-torrent.sample.net/download/free"]
    assert min(map(score, good)) > 0.5 > queries.BLOCKED_BELOW > max(map(score, bad))


def test_urls_of_odd_tables(spark):
    """Repeated rows stay, columns named like the added ones are replaced, a very long URL is scored whole, one class is a constant."""
    long = "http://long.org/" + "a/b" * 200_000
    df = spark.createDataFrame([(1, "http://x.org/a", "mine", "h"), (1, "http://x.org/a", "mine", "h"), (None, long, None, None), (2, "", "", "")],
                               "page_id long, url string, verdict string, host string")
    one = url_labels.labelled_urls(spark).where("label = 0")
    for labelled, verdict in ((one, "block"), (one.limit(0), "allow"), (one.selectExpr("host", "path", "cast(null as int) label"), "allow")):
        rows = urls.filter_urls(df, queries.URL_RULES, labelled).collect()
        assert len(rows) == 4 and {r.verdict for r in rows} == {verdict} and rows[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "score", "verdict"}
        assert sorted((r.page_id or 0, r.host, len(r.path)) for r in rows) == [(0, "long.org", 600_001), (1, "x.org", 2), (1, "x.org", 2), (2, "", 0)]


def test_quality_by_restated_discriminant(spark):
    """Scores from class covariances, their inverses and determinants in plain numpy."""
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    marks = queries.table(spark, SF, "labels").where(queries.remainder(5) != 0).select("doc_id", "quality").collect()
    x = {d: np.array(quality.statistics((t or "").encode())) for d, t in docs}
    own = [np.array([x[d] for d, label in marks if label == k and d in x]) for k in (0, 1)]
    covariances = [np.cov(o, rowvar=False, bias=True) for o in own]
    pooled = sum(len(o) * c for o, c in zip(own, covariances)) / sum(map(len, own))
    density = []
    for o, c in zip(own, covariances):
        c = 0.9 * (0.9 * c + 0.1 * pooled) + 0.1 * np.diag(np.diag(pooled) + 1e-3)
        inverse, spread = np.linalg.inv(c), np.linalg.slogdet(c)[1]
        density.append({d: -0.5 * ((v - o.mean(0)) @ inverse @ (v - o.mean(0)) + spread) for d, v in x.items()})
    prior = math.log(len(own[1]) / len(own[0]))
    got = {r.doc_id: r.score for r in queries.op7_quality(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, _ in docs:
        z = density[1][d] - density[0][d] + prior
        assert abs(got[d] - 1 / (1 + math.exp(-min(500, max(-500, z))))) < 1e-6


def test_quality_of_odd_documents(spark, odd_documents):
    """Null labels are left out, repeated labels count each, and rows without id are scored."""
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0), (4, 0), (5, None), (None, 0), (9, 0)], "doc_id long, quality int")
    rows = quality.score_quality(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id in (1, 2, None)]
    assert max(same) - min(same) < 1e-12 and same[0] > 0.5


def test_toxicity_by_restated_score(spark):
    """The score of a text is the logistic of the mean, over its weighted words, of the mean evidence of their n-grams."""
    rng = np.random.default_rng(0)
    model = toxicity.SubwordModel(rng.normal(0, 1, toxicity.BUCKETS), -0.3)
    score = model.scorer()
    texts = ["", None, "one", "One one ONE two", "Über-größe x-y a", "word " * 5000 + "other"] + [
        r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").limit(50).collect()]
    for text in texts:
        words = Counter("".join(chr(c) for c in (text or "").encode().translate(toxicity.LETTERS)).split(" "))
        total, weight = 0.0, toxicity.SHRINK
        for word, n in words.items():
            if not word:
                continue
            marked = "<" + word + ">"
            grams = {(marked, 0)} | {(marked[i:i + k], k) for k in (4, 5, 6) for i in range(len(marked) - k + 1)}
            grams |= {(marked[:k], k) for k in (7, 8, 9, 10) if k < len(marked)}
            at = {xxhash.xxh3_64_intdigest(g.encode("latin-1"), k) % toxicity.BUCKETS for g, k in grams}
            total += (1 + math.log(n)) * sum(model.evidence[b] for b in at) / len(at)
            weight += 1 + math.log(n)
        want = 1 / (1 + math.exp(-(model.constant + total / weight)))
        assert abs(score(None if text is None else text.encode()) - want) < 1e-9


def test_toxicity_of_odd_documents(spark, odd_documents):
    """Null labels are left out, a column named like the score is replaced, repeated rows and rows without id stay."""
    df = odd_documents.withColumnRenamed("size", "score")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0), (4, 0), (6, 0), (5, None), (None, 0)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(df, labels)
    rows = out.collect()
    assert out.columns.count("score") == 1 and len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text and r.text.startswith("same0 ")}) == 1 and len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score_toxicity(df.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(df, labels.limit(0)).collect()} == {0.0}


def test_near_vectors_over_several_blocks(spark, monkeypatch):
    """Pairs at and just over the threshold, in blocks of 64 vectors that all meet; repeated ids and other columns."""
    monkeypatch.setattr(neardup, "BLOCK_LEAST", 64)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((250, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.standard_normal(base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosines = np.where(np.arange(250) % 2, 0.9502, 0.97)[:, None]
    e = np.concatenate([base, cosines * base + np.sqrt(1 - cosines**2) * away, base[:3]])
    rows = [(i, v.tolist(), "x", i) for i, v in enumerate(e)] + [(7, e[7].tolist(), "y", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string, node long")
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    want = Counter((r[0], int(n)) for r, n in zip(rows, links))
    got = Counter((r.vec_id, r.n_links) for r in neardup.near_vectors(df).collect())
    missed = sum((want - got).values())
    assert missed <= 0.01 * len(rows) and links.sum() >= 500
