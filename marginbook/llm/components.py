"""Connected components of a graph of links, by randomised contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginbook.llm.frames import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``: longs); nodes of one component share a root.

    In each round every node moves to the neighbour (or itself) that is smallest, in even rounds by id and in odd ones by
    pseudo-random numbers; links between the places moved to remain. Rounds by id finish stars around their smallest node
    at once; the others take away a constant share of the nodes whatever the shape of the graph, so the rounds grow with
    the logarithm of its size at most. Nulls and loops are dropped; an empty graph has no nodes.
    """
    spark = edges.sparkSession
    left = checkpoint(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct())
    moves: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(moves)
        draw = (lambda node, n=turn: F.xxhash64(node, F.lit(n))) if turn % 2 else F.col
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(draw("b").alias("draw"), F.col("b").alias("node")))
        near = both.groupBy("a").agg(best.alias("best"))
        own = F.struct(draw("a").alias("draw"), F.col("a").alias("node"))
        move = checkpoint(near.select(F.col("a").alias("node"), F.least("best", own)["node"].alias("root")))
        moves.append(move)
        left = checkpoint(left.join(move.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                          .join(move.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                          .where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    # Follow the moves from the first round to the last; a place that no later round mentions is final.
    out = moves[-1]
    for move in reversed(moves[:-1]):
        later = out.select(F.col("node").alias("root"), F.col("root").alias("further"))
        out = (move.join(later, "root", "left")
               .select("node", F.coalesce("further", "root").alias("root")))
    return out
