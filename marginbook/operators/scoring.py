"""Target assessment: quarter surplus carry-over, achievement and capped score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import safe_ratio


def carry_over(df: DataFrame, keys: Sequence[str], quarter: str = "quarter_id",
               actual: str = "actual_value", target: str = "target_value") -> DataFrame:
    """Let earlier quarters' surpluses make up a quarter that missed its target.

    Adds ``adjust_1..3`` (surplus taken from quarters 1 to 3), ``adjust_quarter_1..3`` (which
    quarter, ``-`` when none) and ``completed``. A quarter above its target takes nothing.
    A window over the key's quarters, four rows at most, supplies the surpluses; the facts behind
    the frame are computed once.
    """
    q = f"CAST({quarter} AS INT)"
    over = f"OVER (PARTITION BY {', '.join(keys)})"
    earned = df.selectExpr("*", *[
        f"round(coalesce(sum(CASE WHEN {q} = {i} AND {actual} > {target} THEN {actual} - {target} END) {over}, 0D), 6) AS __s{i}"
        for i in (1, 2, 3)])
    taken = {i: f"CASE WHEN {actual} <= {target} AND {q} > {i} THEN __s{i} ELSE 0D END" for i in (1, 2, 3)}
    return earned.selectExpr(
        *df.columns, *[f"{e} AS adjust_{i}" for i, e in taken.items()],
        *[f"CASE WHEN {e} > 0 THEN '{i}季度' ELSE '-' END AS adjust_quarter_{i}" for i, e in taken.items()],
        f"{actual} + {' + '.join(f'({e})' for e in taken.values())} AS completed")


def capped_score(rate: Column | str, weight: Column | str, cap: Column | str) -> Column:
    """Score of an achievement ``rate``: weight times rate in percent, held between 0 and the cap.

    ``cap`` is in percent (120 allows 1.2 times the weight).
    """
    r = F.col(rate) if isinstance(rate, str) else rate
    w = F.col(weight) if isinstance(weight, str) else weight
    c = F.col(cap) if isinstance(cap, str) else cap
    return F.when(r > c / 100, w * c).when(r > 0, r * w * 100).otherwise(F.lit(0.0))


def achievement(completed: Column | str, target: Column | str) -> Column:
    return safe_ratio(completed, target)
