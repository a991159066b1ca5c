"""Filter interaction audit: what each filter of a chain removes, for every order of the chain, without running the orders.

The sets of filters applied so far form a subset lattice: a state is a set, an edge adds one filter. An order of k filters is a
path from the empty to the full state, so the k! orders share 2^k states and k * 2^(k-1) edges.

1. One pass over the texts gives each document the set of filters it fails (a bit mask). Documents are counted per part and mask.
2. Every state gets the documents it keeps: those whose mask does not meet the state. What an edge removes is the difference of its
   two ends.
3. A forward pass counts the orders that reach each state, a backward pass those that lead on from it to the full state. Their
   product is the number of orders through an edge; removals weighted with it are the Shapley sums.
4. Each step of each order is an edge, and is read from it.

Only step 1 grows with the documents. It shuffles one narrow row per document and no text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from marginbook.llm.frames import checkpoint, raw

#: Orders, and with them rows a part, grow with the factorial.
FILTERS_MOST = 7
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SIGNS = 200, 50, 2, "#$%&*|"

JUDGED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("text_key", pa.binary())])


def forward_counts(filters: int) -> list[int]:
    """For each state, the ways to reach it from the empty one, filter by filter."""
    ways = [1] + [0] * (2**filters - 1)
    for state in range(2**filters):
        for f in range(filters):
            if not state >> f & 1:
                ways[state | 1 << f] += ways[state]
    return ways


def backward_counts(filters: int) -> list[int]:
    """For each state, the ways that lead from it to the full one."""
    ways = [0] * (2**filters - 1) + [1]
    for state in range(2**filters - 2, -1, -1):
        ways[state] = sum(ways[state | 1 << f] for f in range(filters) if not state >> f & 1)
    return ways


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mask of the four filters that look at one text, and a 128-bit digest of the text."""
    lower = bytes(b for b in range(256) if not 65 <= b <= 90)
    inner = bytes(range(128, 192))
    signs = re.compile(b"[" + re.escape(SIGNS.encode()) + b"]")
    for batch in batches:
        masks, keys = [], []
        for text in raw(batch.column("text")):
            text = text or b""
            # bytes.split() cuts at space and \t to \r, and at nothing else.
            words = text.split()
            capitals, points = len(text.translate(None, lower)), len(text.translate(None, inner))
            masks.append((len(words) < LEAST_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
                         | (100 * capitals > CAPITALS_PERCENT * points) << 2 | (signs.search(text) is not None) << 3)
            keys.append(hashlib.sha256(text).digest()[:16])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()),
                                          pa.array(keys, pa.binary())], schema=JUDGED)


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Documents by the filters they fail: ``doc_id``, ``part``, ``mask`` and the number of rows ``n`` that agree in all of these.

    Bits from the lowest: A under 200 words; B fewer than half of the words distinct; C over 2 % of the code points are A-Z; D holds
    one of ``#$%&*|``; E a smaller ``doc_id`` has the same text. Null texts are empty texts, null parts the empty string. Rows
    without id fail E never and cause it never; rows of one id don't fail E by each other. An empty table gives an empty result.

    E is settled by the least id of each text. Rows are matched with it on text and id together, so that no text, however many copies
    it has, is one key; rows without id are counted together before that.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col(text).cast("string").alias("text"))
    judged = checkpoint(rows.mapInArrow(_judge, from_arrow_schema(JUDGED)).groupBy(*JUDGED.names).agg(F.count("*").alias("n")))
    first = judged.where("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    named = judged.where("doc_id IS NOT NULL").join(first, ["text_key", "doc_id"], "left")
    copied = F.when(F.col("first").isNull(), F.col("mask").bitwiseOR(F.lit(16))).otherwise(F.col("mask"))
    return (named.select("doc_id", "part", copied.alias("mask"), "n")
            .unionByName(judged.where("doc_id IS NULL").select("doc_id", "part", "mask", "n")))


def count_masks(judged: DataFrame, marks: DataFrame, measures: list[str]) -> DataFrame:
    """Rows of ``judged`` per part and mask: ``n`` and, for each flag of ``marks`` (by ``doc_id``), the rows that have it."""
    flags = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(F.col(m).cast("boolean")).alias(m) for m in measures])
    # Rows without id have no marks; kept out of the join, they are no hot key in it.
    named = judged.where("doc_id IS NOT NULL").join(flags, "doc_id", "left")
    nameless = judged.where("doc_id IS NULL").select("*", *[F.lit(False).alias(m) for m in measures])
    rows = named.select(*judged.columns, *measures).unionByName(nameless)
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(m), F.col("n")).otherwise(0)).alias(m) for m in measures])


def audit_orders(counts: DataFrame, letters: str, losses: dict[str, str] | None = None) -> DataFrame:
    """Every order of the filters, step by step, for every part of ``counts`` (``part``, ``mask``, ``n`` and the measures).

    One row per part, ``filter_order`` and ``step``: ``kept`` after the step, ``removed`` in it, ``redundant`` (fail its filter, gone
    before), ``unique_fails`` (fail this filter only), a column for each of ``losses`` (name to measure: the measure's rows removed
    in the step) and ``shapley`` (removals of its filter summed over all orders). Bit i of a mask is the i-th letter.
    """
    k, losses = len(letters), losses or {}
    if not 1 <= k <= FILTERS_MOST or len(set(letters)) != k:
        raise ValueError(f"one to {FILTERS_MOST} filters with different letters are audited")
    states, mask = range(2**k), F.col("mask")

    def total(condition: Column, value: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")

    kept = [F.array(*[total(mask.bitwiseAND(F.lit(s)) == 0, v) for s in states]).alias(f"keep_{v}") for v in ("n", *losses.values())]
    sums = counts.groupBy("part").agg(
        *kept, F.array(*[total(mask.bitwiseAND(F.lit(1 << f)) != 0, "n") for f in range(k)]).alias("fails"),
        F.array(*[total(mask == 1 << f, "n") for f in range(k)]).alias("alone"))
    reach, leave = forward_counts(k), backward_counts(k)

    def lost(value: str, before: Column | int, after: Column | int) -> Column:
        at = lambda state: F.get(f"keep_{value}", F.lit(state))
        return at(before) - at(after)

    edges = [[(s, s | 1 << f) for s in states if not s >> f & 1] for f in range(k)]
    shares = [reduce(Column.__add__, [F.lit(reach[a] * leave[b]) * lost("n", a, b) for a, b in own]).cast("long") for own in edges]
    every = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(a).alias("state"), F.lit(b).alias("after")) for f, own in enumerate(edges) for a, b in own])
    removed = lost("n", F.col("state"), F.col("after"))
    passed = (sums.withColumn("shares", F.array(*shares)).withColumn("edge", F.explode(every)).select("*", "edge.*").select(
        "part", "filter", "state", F.get("keep_n", F.col("after")).alias("kept"), removed.alias("removed"),
        (F.get("fails", F.col("filter")) - removed).alias("redundant"), F.get("alone", F.col("filter")).alias("unique_fails"),
        *[lost(v, F.col("state"), F.col("after")).alias(name) for name, v in losses.items()], F.get("shares", F.col("filter")).alias("shapley")))
    steps = []
    for order in permutations(range(k)):
        state, name = 0, "".join(letters[f] for f in order)
        for number, f in enumerate(order, 1):
            steps.append((name, number, f, state))
            state |= 1 << f
    # k * k! rows, at most 35,280 whatever the documents; each edge meets the orders that lead through it.
    walk = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, state int")
    return passed.join(F.broadcast(walk), ["filter", "state"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *losses, "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The audit of the five filters of ``judge_documents`` over whole texts, with the labelled documents lost in each step.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; a document is good (toxic) if any row of its id has 1 there, and
    neither without rows. Columns of the tables beyond these are ignored.
    """
    marks = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    counts = count_masks(judge_documents(docs, doc_id, text, part), marks, ["good", "toxic"])
    return audit_orders(counts, "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"})
