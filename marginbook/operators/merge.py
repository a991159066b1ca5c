"""Keyed table changes: update, many updates in one pass, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_row_per_key(source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The source with its key proven unique.

    A repeated key raises inside the job, on the executor that meets it. The aggregation
    hashes by the merge key, so the join that follows reuses its partitioning.
    """
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.any_value(F.col(c)).alias(c) for c in cols])
    clash = F.raise_error(F.concat_ws(" ", F.lit("duplicate merge key:"),
                                      *[F.col(k).cast("string") for k in keys]))
    return grouped.select(*keys, F.when(F.col("__rows") > 1, clash.cast("boolean"))
                          .otherwise(F.lit(True)).alias("__hit"), *cols)


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 cond: str | None = None, overwrite_nulls: bool = False) -> DataFrame:
    """Update ``cols`` of ``target`` from the ``source`` row with the same ``keys``.

    Unmatched rows stay. A NULL source value keeps the old one unless ``overwrite_nulls``.
    ``cond`` is SQL over ``a.`` (target) and ``b.`` (source). Columns of ``cols`` the target
    does not have yet are added. A key that occurs twice in ``source`` is an error.
    """
    a = target
    for c in cols:
        if c not in a.columns:
            a = a.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
    extra = [c for c in source.columns if c not in keys and c not in cols] if cond else []
    b = _one_row_per_key(source, keys, [*cols, *extra])
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    hit = F.coalesce(F.col("b.__hit"), F.lit(False))
    if cond:
        hit = hit & F.coalesce(F.expr(cond), F.lit(False))

    def value(name: str):
        new, old = F.col(f"b.{name}"), F.col(f"a.{name}")
        return F.when(hit, new if overwrite_nulls else F.coalesce(new, old)).otherwise(old).alias(name)

    return a.alias("a").join(b.alias("b"), on, "left").select(
        *[value(c) if c in cols else F.col(f"a.{c}") for c in a.columns])


def merge_many(target: DataFrame, updates: Sequence[tuple[DataFrame, Sequence[str]]],
               keys: Sequence[str], default=None) -> DataFrame:
    """Fill a scaffold from several frames that share its key, in one pass.

    The frames are stacked and grouped once, so ten indicators cost one shuffle rather than
    ten joins with a write in between. Two rows for one key and indicator are an error.
    """
    names = [c for _, cols in updates for c in cols]
    types = {c: df.schema[c].dataType.simpleString() for df, cols in updates for c in cols}
    if len(set(names)) != len(names):
        raise ValueError("each column may come from one frame only")
    stacked = None
    for mine, (df, cols) in enumerate(updates):
        part = df.selectExpr(*keys, *[c if c in cols else f"CAST(NULL AS {types[c]}) AS {c}" for c in names],
                             f"{mine} AS __from")
        stacked = part if stacked is None else stacked.unionAll(part)
    grouped = stacked.groupBy(*keys).agg(
        *[F.expr(f"max({c}) AS {c}") for c in names],
        *[F.expr(f"count_if(__from = {i}) AS __n{i}") for i in range(len(updates))])
    repeats = " OR ".join(f"__n{i} > 1" for i in range(len(updates)))
    checked = grouped.filter(
        f"CASE WHEN {repeats} THEN CAST(raise_error('duplicate merge key') AS BOOLEAN) ELSE true END")
    out = target.join(checked.select(*keys, *names), list(keys), "left")
    if default is not None:
        out = out.fillna(default, subset=names)
    return out


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` plus the ``source`` rows whose key it lacks; absent columns become NULL."""
    new = source.join(target.select(*keys).distinct(), list(keys), "left_anti")
    return target.unionByName(new.select(*[c for c in new.columns if c in target.columns]),
                              allowMissingColumns=True)
