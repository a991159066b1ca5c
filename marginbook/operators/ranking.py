"""Ranking inside groups that may be very uneven.

A plain ``rank()`` sorts a whole group in one task. `top_n` finds the few values that can
qualify first and looks the rows up in them; `rank_within` merges repeated values before any
shuffle and splits a group's values over as many tasks as its size asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _long(df: DataFrame, group: Sequence[str], keep: Sequence[str],
          metrics: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per input row and metric; ``sort_value`` is larger for the better-ranked."""
    options = F.array(*[
        F.struct(F.lit(code).alias("index_type"), F.col(name).cast("double").alias("value"),
                 F.expr(f"CAST({'-' if order == 'asc' else ''}{name} AS DOUBLE) + 0D").alias("sort_value"))
        for code, (name, order) in metrics.items()])
    wide = df.select(*group, *keep, F.explode(options).alias("__m"))
    return (wide.select(*group, *keep, "__m.index_type", "__m.value", "__m.sort_value")
            .filter(F.col("value").isNotNull()))


def top_n(df: DataFrame, group: Sequence[str], metrics: Mapping[str, tuple[str, str]], n: int,
          keep: Sequence[str] = (), ties: str = "rank") -> DataFrame:
    """Rows ranked ``n`` or better per group, for several metrics, in long form.

    ``metrics`` maps a code to ``(column, "desc" | "asc")``. With ``ties="rank"`` equal values
    share a rank and all of them are kept; with ``"row_number"`` exactly ``n`` rows stay, ties
    broken by ``keep``. Rows whose metric is NULL are not ranked.
    """
    group = list(group)
    keys = [*group, "index_type"]
    rows = _long(df, group, keep, metrics)
    if ties == "row_number":
        order = Window.partitionBy(*keys).orderBy(F.col("sort_value").desc(), *[F.col(k) for k in keep])
        return (rows.withColumn("rank_no", F.row_number().over(order))
                .filter(F.col("rank_no") <= n).drop("sort_value"))
    # A row ranks n or better exactly when its value is one of the n best rows' values, and its
    # rank is that value's rank among them. Spark cuts each map task to its own n best rows before
    # the shuffle by group, so no task holds a whole group, however the ties fall.
    best = Window.partitionBy(*keys).orderBy(F.col("sort_value").desc())
    leaders = (rows.withColumn("__n", F.row_number().over(best)).withColumn("rank_no", F.rank().over(best))
               .filter(F.col("__n") <= n))
    # At most n values per group: one small row each, broadcast when its measured size allows.
    cut = leaders.groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct("sort_value", "rank_no"))).alias("__ranks"))
    ranked = rows.join(cut, keys).withColumn("rank_no", F.expr("__ranks[sort_value]"))
    return ranked.filter(F.col("rank_no").isNotNull()).drop("sort_value", "__ranks")


def rank_within(df: DataFrame, group: Sequence[str], value: str, name: str = "rank_no",
                descending: bool = True, values_per_range: int = 500_000, ranges_most: int = 256) -> DataFrame:
    """`rank()` of every row in its group, with the group's values spread over many tasks.

    Values are cut into ranges at approximate quantiles, one range for every ``values_per_range`` different values that the group is
    measured to have; a row's rank is the number of rows in better ranges plus its rank inside its own. The
    quantiles only balance the work: ranks are exact wherever the cuts fall. Groups of one range have no cuts; beyond
    ``ranges_most`` ranges the ranges of a group grow with it.
    """
    group = list(group)
    signed = (-F.col(value) if descending else F.col(value)).cast("double")
    values = (df.filter(F.col(value).isNotNull()).groupBy(*group, signed.alias("__v"))
              .agg(F.count(F.lit(1)).alias("__rows")))
    # All cuts that the largest group may need; a smaller one takes every so-manieth of them.
    steps = F.array(*[F.lit(i / ranges_most) for i in range(1, ranges_most)])
    wanted = F.least(F.lit(ranges_most), F.ceil(F.col("__n") / values_per_range)).cast("int")
    picked = F.expr(f"IF(__k < 2, array(), transform(sequence(1, __k - 1), i -> get(__all, CAST(floor(i * {ranges_most} / __k) AS INT) - 1)))")
    cuts = (values.groupBy(*group).agg(F.percentile_approx("__v", steps, 10 * ranges_most).alias("__all"), F.count(F.lit(1)).alias("__n"))
            .withColumn("__k", wanted).select(*group, picked.cast("array<double>").alias("__cuts")))
    matches = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    placed = values.alias("a").join(cuts.alias("b"), matches).select(
        *[F.col(f"a.{g}") for g in group], "__v", "__rows", F.size(F.filter("__cuts", lambda c: c < F.col("__v"))).alias("__bucket"))
    sizes = placed.groupBy(*group, "__bucket").agg(F.sum("__rows").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*group, "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (placed.withColumn("__in", F.coalesce(F.sum("__rows").over(inside), F.lit(0))).alias("a")
             .join(offsets.alias("b"), [*matches, F.col("a.__bucket") == F.col("b.__bucket")])
             .select(*[F.col(f"a.{g}") for g in group], "__v", (F.col("__off") + F.col("__in") + 1).cast("int").alias(name)))
    return (df.withColumn("__v", signed).alias("a").join(ranks.alias("b"), [*matches, F.col("a.__v") == F.col("b.__v")], "left")
            .select(*[F.col(f"a.{c}") for c in df.columns if c != name], F.col(f"b.{name}")))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key by ``order``.

    Spark keeps one row per key in each map task before shuffling, so a hot key sends one row
    per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
