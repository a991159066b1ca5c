"""Semi-additive balances: opening, closing, highest and average over a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import money_sum, safe_ratio
from .calendar import period_calendar


def semi_additive(df: DataFrame, keys: Sequence[str], balance: str, calendar: DataFrame,
                  grain: str = "month", opening: str | None = None, date_col: str = "busi_date",
                  market: str | None = "1") -> DataFrame:
    """Per key and period: opening, closing, highest and average balance.

    Facts exist on trading days. ``opening`` is read on the period's first trading day from its
    own column (previous day's balance) or from ``balance``. ``avg_trade`` divides by trading
    days; ``avg_natural`` counts a balance once for each natural day it stands for.
    """
    first = opening or balance
    cols = list(dict.fromkeys([balance, first]))
    per_day = df.groupBy(*keys, date_col).agg(*[money_sum(c).alias(c) for c in cols])
    cal = period_calendar(calendar, grain, market)
    # A trading day carries itself and the non-trading days after it; a long holiday may carry
    # a balance into the next period, so the weights are per period.
    days = (cal.filter(F.col("trade_date").isNotNull()).groupBy("trade_date", "period")
            .agg(F.count(F.lit(1)).alias("__w"), F.max("first_trade").alias("__first"),
                 F.max("last_trade").alias("__last"), F.max("trade_days").alias("__td"),
                 F.max("natural_days").alias("__nd"),
                 F.max(F.when(F.col("busi_date") == F.col("trade_date"), 1).otherwise(0)).alias("__own"))
            .withColumnRenamed("trade_date", date_col))
    j = per_day.join(days, date_col)
    own = F.col("__own") == 1
    agg = j.groupBy(*keys, "period").agg(
        money_sum(F.when(own & (F.col(date_col) == F.col("__first")), F.col(first))).alias("opening"),
        money_sum(F.when(own & (F.col(date_col) == F.col("__last")), F.col(balance))).alias("closing"),
        F.max(F.when(own, F.col(balance))).alias("highest"),
        money_sum(F.when(own, F.col(balance))).alias("__t"),
        money_sum(F.col(balance) * F.col("__w")).alias("__n"),
        F.max("__td").alias("trade_days"), F.max("__nd").alias("natural_days"))
    return agg.select(*keys, "period", "opening", "closing", "highest",
                      safe_ratio("__t", "trade_days").alias("avg_trade"),
                      safe_ratio("__n", "natural_days").alias("avg_natural"),
                      "trade_days", "natural_days")
