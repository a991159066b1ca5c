"""Trading-calendar operators.

A calendar frame has one row per natural day and market: ``busi_date`` DATE,
``trade_flag`` (1 on trading days) and optionally ``market_no``. It holds some hundred
rows per year whatever the size of the facts, so its windows are the only ones in the
library without a partition key.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Period:
    """Literal bounds for filters that must reach the scan."""

    begin: date | None
    end: date | None
    days: int


def _month_first(month: str) -> date:
    return date(int(month[:4]), int(month[4:6]), 1)


def _next_month(month: str) -> date:
    y, m = int(month[:4]), int(month[4:6])
    return date(y + m // 12, m % 12 + 1, 1)


def one_market(calendar: DataFrame, market: str | None = "1") -> DataFrame:
    """One row per day: a single market's days, repeats removed."""
    cal = calendar
    if market is not None and "market_no" in cal.columns:
        cal = cal.filter(F.col("market_no") == market)
    return cal.groupBy("busi_date").agg(F.max(F.col("trade_flag").cast("int")).alias("trade_flag"))


def period_bounds(calendar: DataFrame, begin: date | None = None, end: date | None = None,
                  begin_month: str | None = None, end_month: str | None = None,
                  month: str | None = None, year: str | None = None,
                  trading: bool = True, market: str | None = "1") -> DataFrame:
    """One row ``begin_date, end_date, days`` for the intersection of all given bounds.

    Month and year bounds are turned into date bounds, so the filter stays on the bare
    column and is pushed into the scan.
    """
    day = F.col("busi_date")
    cond = F.lit(True)
    for low in (begin, begin_month and _month_first(begin_month), month and _month_first(month),
                year and date(int(year), 1, 1)):
        if low:
            cond = cond & (day >= F.lit(low))
    for high in (end and ("<=", end), end_month and ("<", _next_month(end_month)),
                 month and ("<", _next_month(month)), year and ("<=", date(int(year), 12, 31))):
        if high:
            cond = cond & ((day <= F.lit(high[1])) if high[0] == "<=" else (day < F.lit(high[1])))
    cal = one_market(calendar.filter(cond), market)
    if trading:
        cal = cal.filter(F.col("trade_flag") == 1)
    return cal.agg(F.min("busi_date").alias("begin_date"), F.max("busi_date").alias("end_date"),
                   F.count("busi_date").alias("days"))


def fetch_period(calendar: DataFrame, **bounds) -> Period:
    """`period_bounds` as literals: one action, one row."""
    row = period_bounds(calendar, **bounds).first()
    return Period(row["begin_date"], row["end_date"], row["days"])


def trading_day_map(calendar: DataFrame, n: int = 0, market: str | None = "1") -> DataFrame:
    """``busi_date -> trade_date``: back to the last trading day, then ``n`` trading days on.

    Days with no trading day that far away map to NULL.
    """
    up_to = Window.orderBy("busi_date").rowsBetween(Window.unboundedPreceding, 0)
    cal = one_market(calendar, market)
    if n == 0:
        return cal.select("busi_date", "trade_flag",
                          F.max(F.when(F.col("trade_flag") == 1, F.col("busi_date"))).over(up_to)
                          .alias("trade_date"))
    numbered = cal.select("busi_date", "trade_flag", F.sum("trade_flag").over(up_to).alias("ordinal"))
    trading = (numbered.filter("trade_flag = 1")
               .select(F.col("ordinal").alias("target"), F.col("busi_date").alias("trade_date")))
    return (numbered.withColumn("target", F.when(F.col("ordinal") > 0, F.col("ordinal") + n))
            .join(trading, "target", "left").select("busi_date", "trade_flag", "trade_date"))


def period_key(grain: str, day: Column | str = "busi_date") -> Column:
    """The reporting period a day falls in, as text."""
    d = D._c(day)
    if grain == "day":
        return D.day_key(d)
    if grain == "week":
        return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("string")
    if grain == "month":
        return D.month_key(d)
    if grain == "quarter":
        return F.concat(D.year_key(d), D.quarter_of(d))
    if grain == "year":
        return D.year_key(d)
    raise ValueError(f"grain must be one of {GRAINS}")


def period_calendar(calendar: DataFrame, grain: str = "month", market: str | None = "1") -> DataFrame:
    """The calendar with each day's period and that period's bounds and day counts.

    Joining facts to it once, on the date, gives every period's report in one pass: there
    is no job per month and no literal per period.
    """
    cal = trading_day_map(calendar, 0, market).withColumn("period", period_key(grain))
    whole = Window.partitionBy("period")
    trading = F.when(F.col("trade_flag") == 1, F.col("busi_date"))
    return cal.select(
        "busi_date", "trade_flag", "trade_date", "period",
        F.min(trading).over(whole).alias("first_trade"),
        F.max(trading).over(whole).alias("last_trade"),
        F.sum("trade_flag").over(whole).alias("trade_days"),
        F.count("busi_date").over(whole).alias("natural_days"))


def natural_weights(calendar: DataFrame, grain: str = "month", market: str | None = "1") -> DataFrame:
    """``(trade_date, period) -> natural days it stands for``.

    Carrying a balance over the weekend and summing is the same as weighting it by this
    number, without emitting one fact row per natural day.
    """
    return (period_calendar(calendar, grain, market).filter(F.col("trade_date").isNotNull())
            .groupBy("trade_date", "period")
            .agg(F.count(F.lit(1)).alias("carried_days"), F.max("trade_days").alias("trade_days"),
                 F.max("natural_days").alias("natural_days")))


def expand_natural_days(facts: DataFrame, calendar: DataFrame, flows: list[str], stocks: list[str],
                        keep: list[str], date_col: str = "busi_date",
                        natural: str = "n_busi_date", market: str | None = "1") -> DataFrame:
    """One fact row per natural day: stocks carried, flows zero on non-trading days.

    ``follows`` says whether the calendar holds the day before, too. The calendar side is small; Spark broadcasts it when its
    measured size allows.
    """
    before = F.lag("busi_date").over(Window.orderBy("busi_date"))
    days = trading_day_map(calendar, 0, market).select(
        F.col("busi_date").alias(natural), F.col("trade_date").alias(date_col), "trade_flag",
        F.coalesce(before == F.date_sub("busi_date", 1), F.lit(False)).alias("follows"))
    return facts.join(days, date_col).selectExpr(
        natural, "trade_flag", "follows", date_col, *keep, *[f"{c} * trade_flag AS {c}" for c in flows], *stocks)
