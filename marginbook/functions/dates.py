"""Calendar arithmetic as Column expressions (no Python per row)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_day(value: Column | str) -> Column:
    """A DATE from ``yyyyMMdd`` or ``yyyy-MM-dd`` text; NULL when it is neither."""
    return F.try_to_timestamp(F.regexp_replace(_c(value), "-", ""), F.lit("yyyyMMdd")).cast("date")


def day_key(value: Column | str) -> Column:
    """``yyyyMMdd`` text of a DATE, built from integers rather than a formatter."""
    d = _c(value)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("string")


def month_key(value: Column | str) -> Column:
    d = _c(value)
    return (F.year(d) * 100 + F.month(d)).cast("string")


def year_key(value: Column | str) -> Column:
    return F.year(_c(value)).cast("string")


def quarter_of(value: Column | str) -> Column:
    """Quarter as text ``"1"`` to ``"4"``."""
    return F.quarter(_c(value)).cast("string")


def quarter_of_month(month: Column | str) -> Column:
    """Quarter ``"1"`` to ``"4"`` of a ``yyyyMM`` key."""
    return F.ceil(F.substring(_c(month), 5, 2).cast("int") / 3).cast("string")


def iso_week(value: Column | str) -> Column:
    return F.weekofyear(_c(value))


def week_bounds(value: Column | str) -> tuple[Column, Column]:
    """Monday and Sunday of the week."""
    monday = F.date_trunc("week", _c(value)).cast("date")
    return monday, F.date_add(monday, 6)


def prev_year(value: Column | str) -> Column:
    """Same day one year earlier; 29 February becomes 28 February."""
    return F.add_months(_c(value), -12)


def prev_month_day(value: Column | str) -> Column:
    """Same day one month earlier, held to the shorter month's last day."""
    return F.add_months(_c(value), -1)


def month_start(value: Column | str) -> Column:
    return F.trunc(_c(value), "month")


def month_end(value: Column | str) -> Column:
    return F.last_day(_c(value))


def shift_month(key: Column | str, n: int) -> Column:
    """A ``yyyyMM`` key moved by ``n`` months."""
    k = _c(key).cast("int")
    months = F.floor(k / 100) * 12 + k % 100 - 1 + n
    return (F.floor(months / 12) * 100 + F.pmod(months, F.lit(12)) + 1).cast("int").cast("string")


def date_spine(spark: SparkSession, begin: date, end: date, name: str = "busi_date") -> DataFrame:
    """One row per natural day from ``begin`` to ``end`` inclusive (empty when reversed)."""
    days = max((end - begin).days + 1, 0)
    return spark.range(days).select(F.date_add(F.lit(begin), F.col("id").cast("int")).alias(name))
