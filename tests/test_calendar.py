from datetime import date

from pyspark.sql import functions as F

from marginbook.functions import dates as D
from marginbook.operators import calendar as C

from conftest import rows


def test_days_of_a_long_holiday_go_back_to_the_last_trading_day(calendar):
    m = {r.busi_date: r.trade_date for r in C.trading_day_map(calendar).collect()}
    assert m[date(2023, 9, 28)] == date(2023, 9, 28)
    assert m[date(2023, 10, 8)] == date(2023, 9, 28)
    assert m[date(2023, 10, 9)] == date(2023, 10, 9)


def test_shifted_trading_day_starts_from_the_effective_day(calendar):
    m = {r.busi_date: r.trade_date for r in C.trading_day_map(calendar, 1).collect()}
    assert m[date(2023, 10, 2)] == date(2023, 10, 9)
    assert m[date(2023, 9, 27)] == date(2023, 9, 28)
    back = {r.busi_date: r.trade_date for r in C.trading_day_map(calendar, -1).collect()}
    assert back[date(2023, 10, 9)] == date(2023, 9, 28)
    assert back[date(2023, 9, 25)] is None


def test_period_bounds_count_trading_or_natural_days(calendar):
    p = C.fetch_period(calendar, month="202310")
    assert (p.begin, p.end, p.days) == (date(2023, 10, 9), date(2023, 10, 13), 5)
    p = C.fetch_period(calendar, month="202310", trading=False)
    assert (p.begin, p.days) == (date(2023, 10, 1), 15)
    assert C.fetch_period(calendar, year="2024").days == 0
    assert C.fetch_period(calendar, begin_month="202309", end_month="202309").days == 4


def test_expansion_carries_stocks_and_blanks_flows(spark, calendar):
    facts = spark.createDataFrame([(date(2023, 9, 28), 1, 5.0, 100.0)], "busi_date date, k int, fee double, rights double")
    out = C.expand_natural_days(facts, calendar, ["fee"], ["rights"], ["k"])
    got = rows(out.select("n_busi_date", "fee", "rights"), "n_busi_date")
    assert len(got) == 11 and got[0] == (date(2023, 9, 28), 5.0, 100.0) and got[-1] == (date(2023, 10, 8), 0.0, 100.0)


def test_date_functions(spark):
    df = spark.sql("SELECT DATE '2024-02-29' AS d")
    monday, sunday = D.week_bounds("d")
    r = df.select(D.prev_year("d").alias("y"), D.prev_month_day("d").alias("m"), monday.alias("a"), sunday.alias("b"), D.quarter_of("d").alias("q"),
                  D.iso_week("d").alias("w"), D.day_key("d").alias("k"), D.month_key("d").alias("mk")).first()
    assert r == (date(2023, 2, 28), date(2024, 1, 29), date(2024, 2, 26), date(2024, 3, 3), "1", 9, "20240229", "202402")
    shifted = spark.sql("SELECT '202401' AS k").select(D.shift_month("k", -1), D.shift_month("k", 12), D.shift_month("k", 0), D.quarter_of_month("k")).first()
    assert shifted == ("202312", "202501", "202401", "1")
    parsed = spark.sql("SELECT '20240229' AS a, '2024-02-29' AS b, 'x' AS c").select(D.parse_day("a"), D.parse_day("b"), D.parse_day("c")).first()
    assert parsed == (date(2024, 2, 29), date(2024, 2, 29), None)
    assert D.date_spine(spark, date(2024, 2, 1), date(2024, 1, 1)).count() == 0


def test_natural_weights_split_a_holiday_over_two_months(calendar):
    got = {(r.trade_date, r.period): r.carried_days for r in C.natural_weights(calendar).collect()}
    assert got[(date(2023, 9, 28), "202309")] == 3 and got[(date(2023, 9, 28), "202310")] == 8


def test_period_bounds_reach_the_scan(spark, calendar, tmp_path):
    calendar.write.parquet(str(tmp_path / "cal"))
    plan = C.period_bounds(spark.read.parquet(str(tmp_path / "cal")), month="202310")._jdf.queryExecution().executedPlan().toString()
    assert "ThanOrEqual(busi_date,2023-10-01), LessThan(b" in plan  # the plan text is cut there
