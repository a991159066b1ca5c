"""From raw documents to a training mix: five stages, each one operator of ``marginbook.llm``.

Every stage gets the documents its predecessor kept and returns the columns of ``documents``; the last adds how often and
how far each document is taken. ``run`` writes each stage's result and reads it back, so that a lost executor costs one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginbook.llm import decontaminate, jaccard, mixing, substrings, toxicity
from marginbook.llm.frames import checkpoint, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents scored so or higher are rejected.
TOXIC = 0.7


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents scored below ``TOXIC``; the classifier learns from all labels of documents still there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, labels, column="_toxic")
    return scored.where(F.col("_toxic") < TOXIC).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each class of near copies; of repeated rows of it, one each.

    Each row without id is a document of its own, behind those with ids.
    """
    keyed = _keyed(docs)
    classes = jaccard.jaccard_classes(keyed, width=5, percent=80, doc_id="_key")
    kept = classes.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    # In this order both need the texts dealt by key, once.
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key", "text"]).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: the id, and for rows without one numbers above all ids (below them where none are left)."""
    named = docs.where("doc_id IS NOT NULL").withColumn("_key", F.col("doc_id").cast("long"))
    # Numbered before the cut, so the numbers stay.
    nameless = checkpoint(docs.where("doc_id IS NULL").withColumn("_row", F.monotonically_increasing_id()))
    parts = nameless.groupBy(F.shiftright("_row", 33).alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    if not parts:
        return named
    total, starts = 0, []
    for r in parts:
        starts.append((r["_part"], total))
        total += r["n"]
    ends = named.agg(F.min("_key").alias("least"), F.max("_key").alias("most")).first()
    first = (ends["most"] if ends["most"] is not None else -1) + 1
    if first + total > 1 << 63:
        first = ends["least"] - total
    if first < -(1 << 63):
        raise ValueError("ids leave no numbers for the rows without id")
    begin = docs.sparkSession.createDataFrame(starts, "_part long, _start long")
    key = F.lit(first).cast("long") + F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1)
    numbered = nameless.withColumn("_part", F.shiftright("_row", 33)).join(begin, "_part").withColumn("_key", key)
    return named.unionByName(numbered.select(*named.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words of 50-word windows that a document with a smaller id has; texts that lose nothing stay as they are,
    documents that lose every word go."""
    found = substrings.dedup_substrings(docs, width=50)
    cut = F.size("removed") > 0
    return found.where(~cut | (F.col("kept_text") != "")).withColumn(
        "text", F.when(cut, F.col("kept_text")).otherwise(F.col("text"))).select(*_counted())


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that share 10 words or more, or a whole short item, with the benchmark; documents left without a word go."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), nameless=True)
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]) >= F.col("n_words")
    left = found.where((F.size("spans") == 0) | ~whole)
    return decontaminate.cut_spans(left).select(*_counted())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often and how far each document is taken: ``size``, ``source_size``, ``target``, ``repeats`` and ``taken``."""
    return mixing.mix_sources(docs)


def _counted():
    """The columns of ``documents`` with the characters counted anew; a null count stays null."""
    return [F.when(F.col(c).isNotNull(), F.length("text").cast("long")).alias(c) if c == "n_chars" else F.col(c)
            for c in COLUMNS]


STAGES = [("toxicity", reject_toxic), ("near_copies", drop_near_copies), ("substrings", cut_repeats),
          ("decontamination", cut_benchmark), ("mix", mix)]

#: Learnt scores decide the first stage, so SQL can't express the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
