"""Running totals over a complete list of months.

A running total of monthly sums has values only in months with facts. Reports want one for every month of every organisation: a month
without facts keeps the total it found. Both operators here take the list of rows wanted (``spine``) and first bring facts and spine
onto one grid; only then do the windows run, over one key's months.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import money_sum

#: name -> (rows with keys and period, value, "year" or "ever", decimals)
Totals = Mapping[str, tuple[DataFrame, Column | str, str, int]]


def _window(keys: Sequence[str], period: str, since: str):
    if since not in ("year", "ever"):
        raise ValueError("totals run since the year began ('year') or 'ever'")
    parts = [*keys, F.substring(period, 1, 4)] if since == "year" else list(keys)
    return Window.partitionBy(*parts).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)


def running_totals(totals: Totals, spine: DataFrame, keys: Sequence[str], period: str = "period") -> DataFrame:
    """Each total at every row of ``spine`` (``keys`` and ``period``, text of the form yyyyMM), 0 before its first fact.

    A total adds its value over all facts of the key from January of the year, or from the first, to the period's end. NULL
    values add nothing. Facts count whether or not their own month is in the spine; facts of other keys, and of unknown month, are left
    out. Repeated spine rows come out once.

    Facts are summed per key and month before the shuffle, and all totals share it; the windows then hold the months of one key.
    """
    wanted = spine.select(*keys, period, F.lit(True).alias("__wanted"))
    grid = None
    for name, (df, value, _, scale) in totals.items():
        monthly = (df.filter(F.col(period).isNotNull()).groupBy(*keys, period).agg(money_sum(value, scale).alias("__v")))
        part = monthly.select(*keys, period, *[(F.col("__v") if n == name else F.lit(None).cast("double")).alias(n) for n in totals],
                              F.lit(None).cast("boolean").alias("__wanted"))
        grid = part if grid is None else grid.unionAll(part)
    grid = grid.unionByName(wanted, allowMissingColumns=True)
    # A sum keeps months in which only other totals have facts apart from unknown values; each has one row a month at most.
    dense = grid.groupBy(*keys, period).agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in totals], F.max("__wanted").alias("__wanted"))
    return (dense.select(*keys, period, "__wanted", *[
        F.round(F.sum(n).over(_window(keys, period, since)), scale).alias(n) for n, (_, _, since, scale) in totals.items()])
        .filter("__wanted").drop("__wanted"))


def running_distinct(df: DataFrame, item: str, name: str, spine: DataFrame, keys: Sequence[str], period: str = "period",
                     since: str = "year") -> DataFrame:
    """How many different ``item`` a key has had since January (or ever), at every row of ``spine``.

    An item counts in its first month of the year (or ever) and from there on, so counts of months add up and no sets are kept.
    NULL items don't count.
    """
    begin = [F.substring(period, 1, 4).alias("__year")] if since == "year" else []
    first = (df.filter(F.col(item).isNotNull() & F.col(period).isNotNull()).select(*keys, period, item, *begin)
             .groupBy(*keys, item, *(["__year"] if begin else [])).agg(F.min(period).alias(period)))
    return running_totals({name: (first, F.lit(1.0), since, 0)}, spine, keys, period)
