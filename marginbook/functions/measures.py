"""Measure expressions shared by every report.

Money is summed as double and rounded to cents straight away (`money_sum`): the result
then does not depend on the order in which tasks finish, and later ratios start from the
same number on every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nz(value: Column | str) -> Column:
    """NULL as zero."""
    return F.expr(f"coalesce({value}, 0)") if isinstance(value, str) else F.coalesce(value, F.lit(0))


def cents_sql(value: str) -> str:
    """A sum or difference of amounts, as SQL, to the nearest cent.

    The same double as ``round(value, 2)`` for amounts in cents below 9e13, at a twentieth of the cost: ``round`` goes through a decimal
    object for every value, which is most of the time of a report with many sums. Adding zero keeps -0 out.
    """
    return f"(rint(({value}) * 100D) / 100D + 0D)"


def money_sql(value: str, scale: int = 2) -> str:
    """`money_sum` of an SQL expression, as SQL.

    Reports hold hundreds of measures. As SQL text a measure is one call into the JVM instead of
    one per function, which is what building such plans costs most.
    """
    total = f"coalesce(sum({value}), 0D)"
    return cents_sql(total) if scale == 2 else f"round({total}, {scale})"


def money_sum(value: Column | str, scale: int = 2) -> Column:
    """Sum with NULLs as nothing, zero for an empty group, rounded to ``scale``.

    ``value`` is a Column or an SQL expression (usually a column name).
    """
    if isinstance(value, str):
        return F.expr(money_sql(value, scale))
    total = F.coalesce(F.sum(value), F.lit(0.0))
    return F.rint(total * 100) / 100 + F.lit(0.0) if scale == 2 else F.round(total, scale)


def cond_sum(cond: Column | str, value: Column | str, scale: int = 2) -> Column:
    """Conditional sum; rows that fail the condition add nothing."""
    if isinstance(cond, str) and isinstance(value, str):
        return F.expr(money_sql(f"CASE WHEN {cond} THEN {value} END", scale))
    return money_sum(F.when(F.expr(cond) if isinstance(cond, str) else cond, _c(value)), scale)


def cond_count(cond: Column | str) -> Column:
    return F.expr(f"count_if({cond})") if isinstance(cond, str) else F.count_if(cond)


def cond_sums(spec: Mapping[str, tuple[Column | str, Column | str]], scale: int = 2) -> list[Column]:
    """``{name: (condition, value)}`` as a list of aggregate Columns."""
    return [cond_sum(cond, value, scale).alias(name) for name, (cond, value) in spec.items()]


def sums(names: Iterable[str], scale: int = 2) -> list[Column]:
    return [F.expr(f"{money_sql(n, scale)} AS {n}") for n in names]


def safe_ratio(n: Column | str, d: Column | str, scale: float = 1) -> Column:
    """``n / d * scale``; 0 when ``d`` is 0 or NULL, and a NULL ``n`` counts as 0."""
    if isinstance(n, str) and isinstance(d, str):
        times = "" if scale == 1 else f" * {scale}"
        return F.expr(f"CASE WHEN {d} <> 0 THEN coalesce({n}, 0) / {d}{times} ELSE 0D END")
    num, den = _c(n), _c(d)
    ratio = nz(num) / den
    return F.when(den != 0, ratio if scale == 1 else ratio * scale).otherwise(F.lit(0.0))


def growth(now: Column | str, base: Column | str) -> Column:
    """Percentage change against ``base``; 0 when there is no base."""
    if isinstance(now, str) and isinstance(base, str):
        return F.expr(f"CASE WHEN {base} <> 0 THEN (coalesce({now}, 0) / {base} - 1) * 100 ELSE 0D END")
    n, b = _c(now), _c(base)
    return F.when(b != 0, (nz(n) / b - 1) * 100).otherwise(F.lit(0.0))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    return safe_ratio(part, whole, 100)


def bucketize(value: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label by inclusive upper ``edges``; the last label takes what lies above them.

    ``labels`` has one entry more than ``edges``. NULL stays NULL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    v = _c(value)
    out = F.when(v <= F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(v <= F.lit(edge), F.lit(label))
    return out.when(v.isNotNull(), F.lit(labels[-1]))


def col_or_zero(df: DataFrame, name: str) -> str:
    """The column, NULL as zero, or zero if the frame lacks it: sources may carry fewer measures."""
    return f"coalesce({name}, 0D) AS {name}" if name in df.columns else f"0D AS {name}"


def group_concat(value: Column | str, sep: str = "/") -> Column:
    """Deterministic string aggregation: values sorted before joining.

    Meant for groups whose size the data model bounds (departments of one project); the
    values are deduplicated on the map side first, so repeats never travel.
    """
    return F.array_join(F.array_sort(F.collect_set(_c(value))), sep)
