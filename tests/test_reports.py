from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from marginbook.functions.dates import date_spine
from marginbook.plans import analysis, cohorts, income, ledger, settlement, targets

from conftest import rows


def org(spark, level="unit"):
    acc = spark.createDataFrame(
        [(1, "a", "0", 10, date(2022, 5, 1), "110101198506071234"), (2, "b", "1", 10, date(2023, 9, 26), "110101850607123"),
         (3, "c", "4", 20, date(2020, 1, 1), "bad")],
        "fund_account_id int, client_name string, client_type string, branch_id int, open_date date, id_no string")
    bm = spark.createDataFrame([(10, "u1"), (20, None)], "ctp_branch_id int, oa_branch_id string")
    units = spark.createDataFrame([("u1", None, "L1", None)], "departmentid string, canceled string, business_line_id string, respons_line_id string")
    return analysis.Organisation(acc, bm, units, level)


def sett(spark):
    base = [(date(2023, 9, 27), 1, 100.0), (date(2023, 9, 28), 1, 200.0), (date(2023, 9, 28), 2, 50.0), (date(2023, 9, 28), 3, 999.0), (date(2023, 10, 9), 1, 0.0)]
    return spark.createDataFrame([(d, k, k, 10, "1", "S", r, r / 2, 10.0, 3.0, 1.0) for d, k, r in base],
                                 "busi_date date, fund_account_id int, client_id int, branch_id int, money_type string, sett_type string, "
                                 "rights double, yes_rights double, transfee double, market_transfee double, margin double")


def empty_trades(spark):
    return spark.createDataFrame([], "busi_date date, fund_account_id int, money_type string, done_amount double, done_money double, done_amount_pj double, done_money_pj double")


def test_weekend_opening_equity_is_the_day_before(spark, calendar):
    out = settlement.daily_fund_reconciliation(sett(spark), calendar, empty_trades(spark)).filter("fund_account_id = 1")
    got = {r.n_busi_date: r for r in out.collect()}
    assert got[date(2023, 9, 28)].yes_rights == 100.0 and got[date(2023, 9, 28)].remain_transfee == 7.0
    carried = got[date(2023, 10, 1)]
    assert (carried.rights, carried.yes_rights, carried.transfee, carried.risk_degree1, carried.rights_flag) == (200.0, 200.0, 0.0, 0.0, 1)
    assert got[date(2023, 10, 9)].risk_degree1 == 0.0  # no equity, no ratio


def test_monthly_reconciliation_splits_a_holiday(spark, calendar):
    out = settlement.monthly_fund_reconciliation(sett(spark), calendar, empty_trades(spark)).filter("fund_account_id = 1")
    got = {r.period: r for r in out.collect()}
    sep, octo = got["202309"], got["202310"]
    assert (sep.end_rights, sep.max_rights, sep.transfee, sep.trade_days) == (200.0, 200.0, 20.0, 4)
    assert sep.avg_trade_rights == 300.0 / 4 and sep.avg_nature_rights == (100.0 + 200.0 * 3) / 6
    assert octo.avg_nature_rights == 200.0 * 8 / 15 and octo.fund_in == 0.0


def test_levy_rate_falls_back_to_the_default(spark):
    fees = spark.createDataFrame([("1003", "1", "1", 9.0)], "fee_type string, use_status string, data_level string, fee double")
    assert settlement.levy_rate(fees).first()[0] == settlement.DEFAULT_LEVY
    assert settlement.levy_rate(fees.withColumn("use_status", F.lit("0"))).first()[0] == 9.0 / 100_000_000


def test_daily_analysis_compares_with_the_trading_day_a_year_before(spark):
    cal = date_spine(spark, date(2022, 1, 1), date(2023, 12, 31)).selectExpr(
        "busi_date", "'1' AS market_no", "CASE WHEN weekday(busi_date) >= 5 THEN 0 ELSE 1 END AS trade_flag")
    s = spark.createDataFrame([(date(2023, 9, 25), 1, 300.0), (date(2023, 9, 25), 2, 100.0), (date(2022, 9, 23), 1, 100.0), (date(2023, 9, 25), 3, 7.0)],
                              "busi_date date, fund_account_id int, rights double")
    got = {r.busi_date: r for r in analysis.daily_operating_analysis(s, org(spark), cal).collect()}
    day = got[date(2023, 9, 25)]  # a year before is Sunday 25 September: the Friday counts
    assert day.end_rights == 0.04 and day.end_rights_yoy == 300.0 and day.new_end_rights == 0.0
    assert rows(analysis.daily_operating_analysis(s, org(spark, "respons"), cal)) == []


def test_key_clients_kept_new_and_lost(spark, calendar):
    m = spark.createDataFrame([(1, "2022"), (1, "2023"), (2, "2023"), (3, "2022")], "fund_account_id int, period string")
    o = org(spark)
    o = analysis.Organisation(o.accounts, spark.createDataFrame([(10, "u1"), (20, "u1")], "ctp_branch_id int, oa_branch_id string"), o.units)
    jgx = spark.createDataFrame([(1, "2022", 10.0), (1, "2023", 30.0), (2, "2023", 5.0), (3, "2022", 40.0)], "fund_account_id int, period string, jgx double")
    r = cohorts.key_client_programme(m, sett(spark).selectExpr("*", "0D AS delivery_transfee", "0D AS strikefee"), jgx, o, calendar).filter("period = '2023'").first()
    assert (r.qw_client_num_all, r.qw_client_num_1, r.qw_client_num_3, r.qw_client_num_4) == (2, 1, 0, 1)
    assert (r.lose_client_num1, r.lose_client_num4, r.lose_client_num5) == (2, 1, 0.5)
    assert (r.lose_client_num9, r.lose_client_num11, r.lose_client_num12, r.lose_client_num13) == (40.0, 17.5 / 25.0 - 1, 2.0, 20.0)


def test_indicators_match_by_code_prefix_and_summary(spark):
    bal = spark.createDataFrame([("202301", "602101", "B1", None, 5.0), ("202301", "6021", "B1", "考核调减", 2.0), ("202301", "6421", "B1", "", 1.0), ("202301", "6021", "B9", "", 8.0)],
                                "account_period string, account_code string, book_code string, summary string, local_credit_sum double")
    ind = spark.createDataFrame([(ledger.REVENUE, "6021", "n", 1.0), (ledger.MOVED_OUT[0], "6021", "n", -1.0), (ledger.REVENUE, "64", "n", 1.0)],
                                "index_para_name string, index_id string, index_name string, cal_direction double")
    out = spark.createDataFrame([("B9",)], "book_code string")
    got = ledger.indicator_results(bal, ind, out)
    assert rows(got.select("index_para_name", "index_id", "index_value"), "index_value") == [(ledger.MOVED_OUT[0], "6021", -2.0), (ledger.REVENUE, "64", 1.0), (ledger.REVENUE, "6021", 7.0)]
    months = spark.createDataFrame([("202301",), ("202302",)], "month_id string")
    st = {r.month_id: r for r in ledger.profit_statement(got, bal, out, spark.createDataFrame([("B1",)], "book_id string"), months).collect()}
    assert (st["202301"].b6, st["202301"].b14, st["202301"].c6, st["202301"].f5) == (7.0, 0.05, -2.0, 5.0)
    assert st["202302"].b5 == 0.0 and st["202302"].g5 == 5.0


def test_rebates_count_in_their_own_window(spark, calendar):
    reb = spark.createDataFrame([(1, date(2023, 9, 12), 1.0, 10.0), (1, date(2023, 10, 10), 2.0, 20.0)],
                                "fund_account_id int, tx_dt date, ret_fee_amt double, ret_fee_amt_czce double")
    got = {r.period: r.market_reduct for r in income.exchange_rebate(reb, calendar).collect()}
    # October: its own rows of the first column, and the second column of the same days in September.
    assert got["202310"] == 2.0 + 10.0 and "202309" not in got


def test_target_check_needs_filed_rates_or_full_quarters(spark):
    cols = ("year_id string, oa_branch_id string, index_id string, index_type string, index_asses_benchmark string, index_name string, year_target_value double, "
            "quarter_target_1 double, quarter_target_2 double, quarter_target_3 double, quarter_target_4 double, target_growth_rate double, "
            "quarter_target_rate_1 double, quarter_target_rate_2 double, quarter_target_rate_3 double, quarter_target_rate_4 double, index_status string")
    t = spark.createDataFrame([("2023", "u", "1", "0", "3", "n", 100.0, 25.0, 25.0, 25.0, 25.0, 1.0, .25, .25, .25, .25, "1"),
                               ("2023", "v", "1", "0", "3", "n", 100.0, 25.0, 25.0, 25.0, 25.0, 0.5, .25, .25, .25, .25, "1"),
                               ("2023", "u", "2", "1", "6", "n", 1.0, .25, .25, .25, .25, 0.0, 0.0, 0.0, 0.0, 0.0, "1")], cols)
    act = spark.createDataFrame([("2022", "u", "005", 50.0, None), ("2022", "v", "005", 50.0, None)], "period string, org_id string, busi_type string, value double, industry double")
    got = {(r.oa_branch_id, r.index_id): r for r in targets.check_annual_targets(t, act).collect()}
    assert got[("u", "1")].check_result == "1" and got[("u", "1")].growth_rate == 1.0
    assert got[("v", "1")].check_result == "0" and got[("u", "2")].check_result == "1"


def test_reports_accept_empty_facts(spark, calendar):
    none = sett(spark).limit(0)
    assert settlement.daily_fund_reconciliation(none, calendar, empty_trades(spark)).count() == 0
    assert analysis.daily_operating_analysis(none, org(spark), calendar).count() == 0
    assert analysis.equity_analysis(none, org(spark), calendar).count() == 0


def test_deliveries_are_dated_by_the_period_they_settle_in(spark, calendar):
    from marginbook.plans import trades
    cols = ("client_id int, branch_id int, fund_account_id int, money_type string, trade_type string, trade_prop string, security_id int, busi_date date, "
            "sett_date date, data_source string, transfee double, market_transfee double, done_amt double, pay_amount double, margin double, market_margin double")
    row = lambda day, settled, source: (1, 1, 1, "1", "11", "1", 1, day, settled, source, 1.0, 0.5, 1.0, 2.0, 3.0, 1.0)
    old, new = row(date(2023, 9, 26), date(2023, 9, 27), "CTP1"), row(date(2023, 10, 11), date(2023, 10, 12), "CTP2")
    for given, want in (([old], ["20230926"]), ([old, new], ["20230926", "20231011"])):
        got, _ = trades.deliveries(spark.createDataFrame(given, cols), calendar, "day")
        assert sorted(r.period for r in got.collect()) == want
    # By month the newer source decides for the whole month it supplied.
    got, _ = trades.deliveries(spark.createDataFrame([old, row(date(2023, 9, 28), date(2023, 10, 9), "CTP2")], cols), calendar, "month")
    assert sorted(r.period for r in got.collect()) == ["202309", "202309"]


def test_carried_days_need_no_window_over_the_facts(spark, calendar):
    """A carried day's opening rights are the day's before it, read from its own row; 0 where the calendar lacks that day."""
    from datetime import date
    from marginbook.plans import settlement
    sett = spark.createDataFrame([(date(2023, 9, 28), 100.0, 90.0, a) for a in ("a", None)] + [(date(2023, 10, 13), -5.0, 100.0, "a")],
                                 "busi_date date, rights double, yes_rights double, fund_account_id string").selectExpr(
        "*", "fund_account_id AS client_id", "1 AS branch_id", "'1' AS sett_type", "'1' AS money_type")
    trades = spark.createDataFrame([], "busi_date date, fund_account_id string, money_type string, done_amount double, done_money double, "
                                       "done_amount_pj double, done_money_pj double")
    out = settlement.daily_fund_reconciliation(sett, calendar.filter("busi_date <> DATE '2023-10-01'"), trades)
    got = {(r.fund_account_id, r.n_busi_date.isoformat()): r.yes_rights for r in out.collect()}
    assert got["a", "2023-09-28"] == 90.0 and got["a", "2023-09-30"] == 100.0 and got[None, "2023-10-03"] == 100.0
    assert got["a", "2023-10-02"] == 0.0 and got[None, "2023-10-02"] == 0.0 and got["a", "2023-10-14"] == -5.0
    assert "lag(rights" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_year_before_is_found_without_a_second_reading(spark):
    from marginbook.plans.analysis import _last_year
    df = spark.createDataFrame([("a", "202301", 1.0), ("a", "202312", 2.0), ("a", "202401", None), ("a", "202412", 4.0), ("a", "202501", 5.0), ("b", "202401", 6.0),
                                (None, "202301", 7.0), (None, "202401", 8.0), ("a", None, 9.0)], "org_id string, period string, v double")
    got = _last_year(df, ["v"])
    assert {(r.org_id, r.period): r.last_v for r in got.collect() if r.last_v is not None} == {("a", "202401"): 1.0, ("a", "202412"): 2.0}
    assert got.count() == 9 and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def _outputs(plan):
    """Output names of each exchange of a physical plan."""
    own = [{a.name() for a in _seq(plan.output())}] if "Exchange" in plan.nodeName() else []
    return own + [names for child in _seq(plan.children()) for names in _outputs(child)]


def _seq(scala):
    return [scala.apply(i) for i in range(scala.size())]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_contracts_are_joined_without_a_shuffle_of_the_sums(spark, calendar, grain):
    """Contracts too many for a broadcast; a contract with half of the rows, one listed twice, unknown ones, and rows without account or contract."""
    from marginbook.plans import trades
    amounts = ("transfee market_transfee settfee holdmovefee market_settfee market_holdmovefee today_profit close_profit_bydate close_profit_bytrade "
               "hold_profit_bydate hold_profit_bytrade market_value hold_amount done_amt done_sum close_amount_today close_money_today amount sett_price "
               "hand_amount margin market_margin socrt_openfee settlementfee add_fee1 add_fee2 done_amount done_money pay_amount strikefee market_strikefee "
               "execute_transfee market_execute_transfee performfee market_performfee strike_qty strike_price optstrike_profit strikefrozenmargin "
               "exchstrikefrozenmargin").split()
    facts = spark.range(4000).selectExpr(
        "CASE WHEN id % 4 < 2 THEN 7 WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN 9999 ELSE id % 50 END AS security_id",
        "CASE WHEN id % 31 <> 0 THEN id % 13 END AS fund_account_id", "id % 13 AS client_id", "CAST(id % 3 AS INT) AS branch_id", "'1' AS money_type",
        "elt(id % 3 + 1, '11', '12', '21') AS trade_type", "CAST(id % 5 DIV 2 + 1 AS STRING) AS trade_prop", "CAST(id % 2 AS STRING) AS bs_direction",
        "elt(id % 2 + 1, '1', '3') AS trade_order", "'0' AS force_flag", "'0' AS strike_type", "'CTP1' AS data_source",
        "DATE '2023-09-26' + CAST(id % 3 AS INT) AS busi_date", "DATE '2023-09-26' + CAST(id % 3 AS INT) AS sett_date",
        *[f"CAST(id % {i + 5} AS DOUBLE) + 0.25D AS {c}" for i, c in enumerate(amounts)])
    contracts = spark.range(3001).selectExpr(
        "CASE WHEN id = 3000 THEN 3 ELSE id END AS security_id", "elt(id % 2 + 1, 'CFFEX', 'DCE') AS market_id", "concat('p', id) AS product_id",
        "'c1' AS contract_code", "'2024' AS delivery_year", "'05' AS delivery_month", "CAST(NULL AS STRING) AS delivery_date", "CAST(NULL AS STRING) AS end_delivery_date")
    accounts = spark.range(10).selectExpr("id AS fund_account_id", "concat('t', id) AS client_type", "DATE '2020-01-01' AS open_date")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = trades.trade_statistics(facts, facts, facts, facts.filter("trade_prop = '3'"), facts.filter("trade_order = '3'"), contracts, accounts, calendar, grain)
        assert not [names for names in _outputs(out._jdf.queryExecution().executedPlan()) if "h_hold_money" in names]
        got = out.collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    period = (lambda d: d.strftime("%Y%m%d")) if grain == "day" else (lambda d: d.strftime("%Y%m"))
    last = {}
    for r in (given := facts.collect()):
        last[period(r.busi_date)] = max(r.busi_date, last.get(period(r.busi_date), r.busi_date))
    if grain == "month":
        last["202309"] = date(2023, 9, 28)
    sums, keys = Counter(), set()
    for r in given:
        own = (period(r.busi_date), r.client_id, r.branch_id, r.fund_account_id, r.money_type, r.trade_type, r.trade_prop, r.security_id)
        if r.security_id not in (None, 9999):
            at_end = r.busi_date == last[own[0]]
            keys.add(own)
            sums[own, "money"] += r.done_sum
            sums[own, "tj"] += (r.trade_prop == "1") * r.margin
            sums[own, "tb"] += (r.trade_prop == "3") * (r.margin + at_end * r.margin)
            sums[own, "buy"] += (r.bs_direction == "0") * {"11": 0, "12": at_end * r.amount * r.sett_price * r.hand_amount, "21": r.market_value}[r.trade_type]
    by = {}
    for r in got:
        by.setdefault(tuple(r)[:8], []).append(r)
    # Exercise of type 21 is booked on the next trading day, so there are keys of such rows alone.
    assert keys <= set(by) and all(k[5] == "21" for k in set(by) - keys)
    for own in by:
        first = by[own][0]
        assert sorted(r.product_id for r in by[own]) == (["p3", "p3000"] if own[7] == 3 else [f"p{own[7]}"])
        assert first.client_type == (f"t{own[3]}" if own[3] is not None and own[3] < 10 else None)
        assert [first.done_money, first.margin_tj, first.margin_tb, first.buy_hold_money_qq] == [
            pytest.approx(sums[own, n], abs=0.006) for n in ("money", "tj", "tb", "buy")]
