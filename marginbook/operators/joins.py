"""Joins with a meaning of their own: totals, scaffolds, effective rates, cohorts, allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.measures import money_sum


def against_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Add a one-row frame's columns to every row, as scalar subqueries: no join, no shuffle."""
    packed = total.select(F.struct(*total.columns)).scalar()
    return (df.withColumn("__total", packed)
            .select(*df.columns, *[F.col(f"__total.{c}").alias(c) for c in total.columns]))


def scaffold(units: DataFrame, indicators: DataFrame | Sequence[tuple], names: Sequence[str] = ()) -> DataFrame:
    """Every unit with every indicator.

    One side is a short configuration table, given as a frame or as rows. Spark chooses the plan by the measured sizes; nothing
    runs while the plan is built, and the columns keep their types whatever the number of rows.
    """
    if not isinstance(indicators, DataFrame):
        spark = units.sparkSession
        indicators = (spark.createDataFrame(list(indicators), list(names)) if indicators else
                      spark.createDataFrame([], ", ".join(f"{n} string" for n in names)))
    return units.crossJoin(indicators)


def spread_over_days(spans: DataFrame, calendar: DataFrame, begin: str, end: str,
                     date_col: str = "busi_date", step: str = "INTERVAL 1 DAY") -> DataFrame:
    """Intervals (bounds inclusive) as one row per day or month, cut to the calendar's range.

    An effective-dated lookup then is an equality join on the date; nothing is compared row by row.
    """
    bounds = calendar.agg(F.min("busi_date").alias("__lo"), F.max("busi_date").alias("__hi"))
    # Steps start at the interval's own begin, so a monthly step keeps to its day of the month.
    clipped = against_total(spans, bounds).filter(f"{begin} <= least({end}, __hi) AND {end} >= __lo")
    return (clipped.withColumn(date_col, F.explode(F.expr(f"sequence({begin}, least({end}, __hi), {step})")))
            .filter(f"{date_col} >= date_trunc('month', __lo)")
            .select(date_col, *[c for c in spans.columns if c not in (begin, end)]))


def daily_rates(rates: DataFrame, calendar: DataFrame, rate: str, begin: str, end: str,
                date_col: str = "busi_date") -> DataFrame:
    """Effective-dated rates as one row per day of the calendar's range."""
    return spread_over_days(rates.select(begin, end, rate), calendar, begin, end, date_col).select(date_col, rate)


def monthly_parameters(parameters: DataFrame, calendar: DataFrame, begin: str = "begin_month", end: str = "end_month",
                       month: str = "busi_month") -> DataFrame:
    """Parameters valid for a range of ``yyyyMM`` months as one row per month."""
    spans = parameters.withColumns({k: F.to_date(F.concat(F.col(k), F.lit("01")), "yyyyMMdd") for k in (begin, end)})
    rows = spread_over_days(spans, calendar, begin, end, "__day", "INTERVAL 1 MONTH")
    return rows.withColumn(month, month_key("__day")).drop("__day")


def effective_rate(facts: DataFrame, rates: DataFrame, calendar: DataFrame, rate: str = "interest_rate",
                   begin: str = "begin_date", end: str = "end_date", date_col: str = "busi_date",
                   default: float | None = None) -> DataFrame:
    """Attach the rate in force on each fact's day (bounds inclusive).

    Without ``default`` facts outside every interval drop out, as in an inner join. Overlapping
    intervals give one row per interval.
    """
    per_day = daily_rates(rates, calendar, rate, begin, end, date_col)
    if default is None:
        return facts.join(per_day, date_col)
    return (facts.join(per_day, date_col, "left")
            .withColumn(rate, F.coalesce(F.col(rate), F.lit(default))))


def cohort_split(prev: DataFrame, curr: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key with ``cohort``: ``kept``, ``new`` or ``lost``; one shuffle for all three."""
    keys = list(key)
    marked = (prev.select(*keys).withColumn("__p", F.lit(1)).withColumn("__c", F.lit(0))
              .unionByName(curr.select(*keys).withColumn("__p", F.lit(0)).withColumn("__c", F.lit(1))))
    seen = marked.groupBy(*keys).agg(F.max("__p").alias("__p"), F.max("__c").alias("__c"))
    return seen.select(*keys, F.when((F.col("__p") == 1) & (F.col("__c") == 1), "kept")
                       .when(F.col("__c") == 1, "new").otherwise("lost").alias("cohort"))


def entity_match(left: DataFrame, right: DataFrame, id_col: str = "id_no", name_col: str = "client_name") -> DataFrame:
    """Match on identity number and name, both trimmed of blanks; rows without either do not match."""
    for c in (id_col, name_col):
        left = left.withColumn(c, F.trim(F.col(c)))
        right = right.withColumn(c, F.trim(F.col(c)))
    return left.join(right, [id_col, name_col])


def allocate(df: DataFrame, weights: DataFrame, keys: Sequence[str], measures: Sequence[str],
             rate: str = "alloca_rate") -> DataFrame:
    """Each measure times the allocation rate of every receiver of its key."""
    passed = [c for c in weights.columns if c not in keys and c != rate]
    own = [c for c in df.columns if c not in keys and c not in measures]
    return df.join(weights, list(keys)).select(
        *keys, *own, *passed, *[(F.col(m) * F.col(rate)).alias(m) for m in measures])


def allocated_totals(df: DataFrame, weights: DataFrame, keys: Sequence[str], measures: Sequence[str],
                     by: Sequence[str], rate: str = "alloca_rate", scale: int = 4) -> DataFrame:
    """`allocate`, summed per receiver."""
    return allocate(df, weights, keys, measures, rate).groupBy(*by).agg(
        *[money_sum(m, scale).alias(m) for m in measures])
