"""Mixing sources to target weights by capped water-filling, with DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash prefixes of a source's documents; only running sums over prefixes go through one task per source.
PREFIX_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weight: str, size: str, epochs: float) -> DataFrame:
    """Add ``target``: shares of the summed sizes by weight, at most ``epochs`` times a source's size.

    Clamping the sources over their limit and sharing their excess by weight until none is over is solved at once: with
    the sources in order of limit / weight, the level when the first k are clamped is (total - their limits) / (weight
    of the rest); it rises while clamped sources are over it and falls afterwards, so the water level is its maximum.
    """
    limit = F.col(size) * F.lit(float(epochs))
    order = Window.orderBy(limit / F.col(weight), F.col(size), F.col("source_null"), F.col("source_key"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum(size).over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (
        F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0.0)))
    return (sources.withColumn("_level", level)
            .withColumn("_level", F.max("_level").over(everything))
            .withColumn("target", F.least(limit, F.col("_level") * F.col(weight)))
            .drop("_level"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: float = 3.0, seed: int = 17,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``repeats`` and ``taken``.

    Sources in code-point order, null last, weigh ``weights`` in turn. ``size`` is a text's words (null text: 0). A
    source's documents are all taken ``repeats`` whole times; the rest of its target is filled by one more partial
    round in a seeded random order, the last document of which gives only the words still missing. So
    the words taken of a source are its target, rounded, and no document exceeds ``epochs`` times its size. Rows without id
    are ordered by a hash of their text. Repeated
    rows count each for itself; rows alike in id and size are told apart arbitrarily, which changes no total. A source
    whose texts are all empty gets the target 0. An empty table gives an empty result. Columns of ``docs`` called like
    the added ones are replaced.

    Sizes are summed per source and hash prefix; the running sum over the prefixes and the order within a prefix give each
    document's place, so a hot source is spread over all tasks.
    """
    added = ("size", "source_size", "target", "repeats", "taken")
    kept = [c for c in docs.columns if c not in added]
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.col(text))))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), name))
    rows = (docs.select(*kept)
            .withColumn("size", word_count(F.col(text)))
            .withColumn("source_key", F.coalesce(F.col(source).cast("string"), F.lit("")))
            .withColumn("source_null", F.col(source).isNull())
            .withColumn("_key", key)
            .withColumn("_prefix", F.substring("_key", 1, PREFIX_DIGITS)))
    by_source = ["source_null", "source_key"]
    prefixes = rows.groupBy(*by_source, "_prefix").agg(F.sum("size").alias("prefix_size"))
    sources = prefixes.groupBy(*by_source).agg(F.sum("prefix_size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("source_null", "source_key"))
    shares = F.array(*(F.lit(float(w)) for w in weights))
    weighed = sources.withColumn("_weight", F.element_at(shares, (rank - 1) % len(weights) + 1))
    targets = (water_fill(weighed, "_weight", "source_size", epochs)
               .withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
               .withColumn("_extra", (F.round("target") - F.col("repeats") * F.col("source_size")).cast("long"))
               .drop("_weight"))
    earlier = Window.partitionBy(*by_source).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    places = (prefixes.withColumn("_earlier", F.coalesce(F.sum("prefix_size").over(earlier), F.lit(0)))
              .drop("prefix_size").join(targets, by_source))
    within = (Window.partitionBy(*by_source, "_prefix").orderBy("_key", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    partial = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_extra") - F.col("_earlier") - F.col("_within")))
    return (rows.join(places, [*by_source, "_prefix"])
            .withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .withColumn("taken", (F.col("repeats") * F.col("size") + partial).cast("long"))
            .select(*kept, *added))
