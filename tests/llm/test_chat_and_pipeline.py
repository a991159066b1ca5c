import importlib

import pyarrow as pa

from marginbook.llm import chat, jaccard, queries, toxicity
from marginbook.llm.frames import checkpoint
from pyspark.sql import functions as F
from tools.check_sql import compare, connect

import corpus_pipeline

from . import brute

SF = "/root/testdata/sf0.001"


def test_sql_twins(spark):
    con = connect(SF)
    for name, sql in queries.SQL.items():
        ok, note = compare(spark, con, SF, name, queries.QUERIES[name], sql)
        assert ok, (name, note)


def test_chats_read_back(spark):
    said = [("user", "<|im_end|>\n&lt;| <|turn|> &amp;"), ("user", "<"), ("assistant", "|a <|im_start|>user\nb<"), ("assistant", ""), ("a\nb&<|", None), (None, "x")]
    rows = [(7, i, r, t) for i, (r, t) in enumerate(said)] + [(8, None, "assistant", "z"), (8, 1, "user", "y"), (8, 1, "user", "y"), (None, 1, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat.format_chats(df).withColumn("back", chat.read_chat(F.col("formatted")))
    got = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in got[7].back] == [(r or "", t or "") for r, t in said]
    assert got[7].formatted.count("<|im_start|>") == 4 and "".join(p.text for p in got[7].pieces) == got[7].formatted
    learnt = "".join(p.text for p in got[7].pieces if p.loss)
    assert learnt.replace("&lt;|", "<|").replace("&amp;", "&") == said[2][1]
    assert [tuple(t) for t in got[8].back] == [("assistant", "z"), ("user", "y"), ("user", "y")] and len(got[None].back) == 1
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_chat_with_other_columns(spark):
    """20,000 turns in runs of one role, and given columns named like the added ones."""
    df = spark.range(20_000).selectExpr("5L AS conv_id", "id AS turn", "if(id % 5 < 3, 'user', 'assistant') AS role",
                                        "concat('<|', id, '&') AS text", "'f' AS formatted", "id AS pieces").repartition(4)
    row = chat.format_chats(df).withColumn("back", chat.read_chat(F.col("formatted"))).first()
    assert [tuple(t) for t in row.back] == [("user" if i % 5 < 3 else "assistant", f"<|{i}&") for i in range(20_000)]
    assert row.formatted.count(chat.START) == 8_000 and "".join(p.text for p in row.pieces) == row.formatted


def test_pipeline_of_odd_tables(spark, odd_documents, tmp_path):
    """Null texts stay to the end, a table without labels rejects nothing, and empty tables give none."""
    for name, docs in (("odd", odd_documents), ("none", odd_documents.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.withColumnRenamed("size", "n_chars").selectExpr("doc_id", "text", "lang", "source", "cast(n_chars as bigint) n_chars").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        texts = [r.text for r in rows]
        assert name == "odd" and None in texts and "" in texts and sum((t or "").startswith("same0 ") for t in texts) == 1 or not rows


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "substrings", "decontamination", "mix"]
    assert out.columns[:len(columns)] == columns and 0 < out.count() < sizes[0]
    assert out.groupBy("doc_id").count().where("count > 1").count() == 0


def test_pipeline_by_brute_force(spark, monkeypatch):
    """Each document's text and words taken, from the learnt scores on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = checkpoint(toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), column="_toxic"))
    monkeypatch.setattr(toxicity, "score_toxicity", lambda *args, **named: scored)
    kept = [r for r in scored.collect() if r["_toxic"] < corpus_pipeline.TOXIC]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute.pipeline([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in kept], items)
    got = corpus_pipeline.run(spark, SF).select(*corpus_pipeline.COLUMNS, "size", "source_size", "target", "repeats", "taken").collect()
    target = {r.doc_id: r.target for r in got}
    assert sorted(tuple(r[:7] + r[8:]) for r in got) == sorted(r[:7] + r[8:] for r in want)
    assert all(abs(target[r[0]] - r[7]) < 1e-6 * max(1, r[7]) for r in want)


def test_rows_without_id_are_near_copies_too(spark):
    same, other = (" ".join(f"{a}{i}" for i in range(60)) for a in "sa")
    rows = [(5, same), (None, same), (None, same + " end"), (None, other), (None, other), (None, other + " end"), (9, "one"), (None, ""), (None, None)]
    for top in (5, (1 << 63) - 1):
        df = spark.createDataFrame([(top if i == 5 else i, t, "en", "s", 1) for i, t in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
        left = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
        assert len(left) == 5 and (9, "one") in left and (None, "") in left and (None, None) in left
        assert sum((t or "").startswith("s0 ") for _, t in left) == sum((t or "").startswith("a0 ") for _, t in left) == 1
        assert top != 5 or (5, same) in left


def test_every_operator_has_a_query():
    names = list(importlib.import_module("__spark_entry__").queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_python_gets_small_batches(spark, tmp_path):
    """Tasks of the toxicity and near_copies stages hold a few megabytes of texts at a time, not 10,000 rows."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])
    texts = spark.range(3000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 1000) AS text").coalesce(1)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    for stage in (lambda: toxicity.score_toxicity(texts, labels), lambda: jaccard.jaccard_classes(texts.limit(3))):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage()
        assert texts.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0] < 6 << 20
