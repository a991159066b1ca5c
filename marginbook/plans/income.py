"""Income reports: products and their allocation, brokerage, cooperation, own investments.

All reports cover every month of their inputs at once; monthly bounds come from the calendar
by date, and facts are summed per account before they meet agreements, relations or accounts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.measures import cond_sums, group_concat, money_sum, nz, safe_ratio, sums
from ..operators.calendar import one_market, period_calendar, trading_day_map
from ..operators.joins import daily_rates, monthly_parameters
from ..operators.ranking import latest_per_key
from ..operators.spine import spine_merge

RETAINED = ("transfee", "delivery_transfee", "strikefee")


def retained_fee() -> Column:
    """Client fees less the exchange's share."""
    own = sum((nz(c) for c in RETAINED[1:]), nz(RETAINED[0]))
    return own - sum((nz(f"market_{c}") for c in RETAINED[1:]), nz(f"market_{RETAINED[0]}"))


def trading_months(calendar: DataFrame) -> DataFrame:
    """Trading days with their month, its first and last trading day and day counts."""
    return (period_calendar(calendar, "month").filter("trade_flag = 1")
            .select("busi_date", "period", "first_trade", "last_trade", "trade_days", "natural_days"))


# ---- product income -------------------------------------------------------------------------

def product_income(values: DataFrame, product_accounts: DataFrame, products: DataFrame, parameters: DataFrame,
                   calendar: DataFrame, fund_of_funds: bool, product_fees: DataFrame | None = None) -> DataFrame:
    """Income of each product and month, without tax.

    ``values`` are daily account values, ``product_accounts`` says which accounts a product
    trades through, ``products`` lists each month's products, ``parameters`` holds tax and
    interest rates by month range (1 where none applies). Funds of funds keep exactly the listed
    products and add the product's own fees; ordinary products also keep accounts' products that
    are not listed, with zero where a side is missing.
    """
    days = trading_months(calendar)
    last = F.col("busi_date") == F.col("last_trade")
    per_account = values.join(days, "busi_date").groupBy("fund_account_id", F.col("period").alias("busi_month")).agg(
        money_sum("all_ri_amt").alias("sum_rights"), money_sum(F.when(last, F.col("today_ri_amt"))).alias("end_rights"),
        money_sum("subsistence_fee_amt").alias("clear_remain_transfee"), money_sum("calint_amt").alias("interest_base"),
        money_sum("exchangeret_amt").alias("market_reduct"), money_sum("i_int_amt").alias("client_ret_interest"),
        money_sum("i_exchangeret_amt").alias("client_ret_marreduct"), F.max("trade_days").alias("days"))
    measures = ["end_rights", "sum_rights", "interest_base", "clear_remain_transfee", "market_reduct",
                "client_ret_marreduct", "client_ret_interest"]
    on = ["fund_account_id"] + (["busi_month"] if "busi_month" in product_accounts.columns else [])
    per_product = per_account.join(product_accounts, on).groupBy("busi_month", "filing_code").agg(
        *sums(measures), F.max("days").alias("days")).withColumn("avg_rights", safe_ratio("sum_rights", "days"))
    mark = F.col("product_name").contains("FOF")
    listed = products.filter(mark if fund_of_funds else ~mark).select("busi_month", "filing_code", "product_name")
    out = listed.join(per_product.drop("days"), ["busi_month", "filing_code"], "left" if fund_of_funds else "full")
    if not fund_of_funds:
        out = out.fillna(0.0, [*measures, "avg_rights"])
    elif product_fees is not None:
        out = out.join(product_fees.select("busi_month", "filing_code", "manage_fee_income", "sales_incentives"),
                       ["busi_month", "filing_code"], "left")
    rates = monthly_parameters(parameters, one_market(calendar)).select("busi_month", "tax_rate", "interest_rate")
    out = out.join(rates, "busi_month", "left")
    tax, interest = F.coalesce("tax_rate", F.lit(1.0)), F.coalesce("interest_rate", F.lit(1.0))
    net = {f"{c}_extax": F.col(c) / (1 + tax) for c in
           ("client_ret_marreduct", "market_reduct", "clear_remain_transfee", "manage_fee_income") if c in out.columns}
    out = out.select(*[c for c in out.columns if c not in ("tax_rate", "interest_rate")],
                     *[v.alias(k) for k, v in net.items()],
                     (F.col("interest_base") * (1 + interest) / 360).alias("interest_income"))
    return out.withColumn("total_futu_income", F.col("clear_remain_transfee_extax") + F.col("market_reduct_extax")
                          + F.col("interest_income") - F.col("client_ret_marreduct_extax") - F.col("client_ret_interest"))


def fund_of_funds_shares(confirms: DataFrame, products: DataFrame, sellers: DataFrame, advisers: DataFrame,
                         sett: DataFrame, product_accounts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Average equity of each fund of funds credited to the staff who sell or advise it.

    ``sellers`` gives staff rates per product and client, ``advisers`` the adviser shares per
    product, unit and staff member; ``product_accounts`` lists a product's accounts by month. A seller's share is client shares times rate over the
    product's latest total shares.
    """
    days = trading_months(calendar)
    held = confirms.join(days, "busi_date").groupBy("period", "filing_code", "client_name").agg(
        money_sum("confirm_share").alias("client_share"))
    total = latest_per_key(products, ["filing_code"], [F.col("busi_month").desc()]).select("filing_code", "product_total_share")
    sold = (held.join(sellers, ["filing_code", "client_name"]).groupBy("period", "filing_code", "oa_branch_id", "oa_broker_name")
            .agg(money_sum("client_share").alias("sales_share"),
                 money_sum(F.col("client_share") * F.col("oa_broker_name_rate"), 4).alias("weighted")))
    sold = sold.join(total, "filing_code", "left").withColumn("prop", safe_ratio("weighted", "product_total_share"))
    equity = (sett.join(days, "busi_date").groupBy("fund_account_id", "period").agg(
        money_sum("rights").alias("rights"), F.max("trade_days").alias("days"))
        .join(product_accounts.select("fund_account_id", F.col("busi_month").alias("period"), "filing_code"),
              ["fund_account_id", "period"])
        .groupBy("period", "filing_code").agg(money_sum("rights").alias("rights"), F.max("days").alias("days"))
        .select("period", "filing_code", safe_ratio("rights", "days").alias("fof_avg_rights")))
    out = equity.join(advisers, "filing_code").join(
        sold.select("period", "filing_code", "oa_branch_id", "oa_broker_name", "sales_share", "prop"),
        ["period", "filing_code", "oa_branch_id", "oa_broker_name"], "left")
    by_sale = F.col("fof_avg_rights") * (1 - F.col("oa_branch_advisor_rate")) * nz("prop")
    by_advice = F.col("fof_avg_rights") * F.col("oa_branch_advisor_rate") * F.col("oa_broker_advisor_rate")
    return out.select("period", "filing_code", "oa_branch_id", "oa_broker_name",
                      by_sale.alias("sales_product_avg_rights"), by_advice.alias("advisor_avg_rights"),
                      (by_sale + by_advice).alias("sum_avg_rights"), nz("sales_share").alias("sales_share"), "fof_avg_rights")


# ---- brokerage income -------------------------------------------------------------------------

# Rebate columns and the window each counts in. "current" is the month itself,
# "previous" the same days one month earlier, "before_cutoff" as previous up to the cut-off.
REBATE_WINDOWS = {
    "exchange_txfee_amt": "current", "ret_fee_amt": "current", "ret_fee_amt_czce": "previous",
    "ret_fee_amt_dce": "previous", "ret_fee_amt_shfe": "current", "ret_fee_amt_shfe1": "before_cutoff",
    "ret_fee_amt_cffex": "previous", "ret_fee_amt_cffex2021": "previous", "ret_fee_amt_dce31": "previous",
    "ret_fee_amt_dce32": "previous", "ret_fee_amt_dce33": "previous", "ret_fee_amt_dce1": "previous",
    "ret_fee_amt_dce2": "previous", "investor_ret_amt": "current",
}
REBATE_CUTOFF = "2022-05-01"
# Cooperation reports count one exchange's rebate in both windows.
COOPERATION_WINDOWS = {**REBATE_WINDOWS, "ret_fee_amt_dce": "both"}


def rebate_days(calendar: DataFrame, trading: bool = True) -> DataFrame:
    """``(tx_dt, period, window)``: which month counts a day, and as which window.

    A month's window runs from its first to its last (trading) day; the previous window is the
    same two days moved one month back. A day can belong to a month as both.
    """
    cal = period_calendar(calendar, "month")
    kept = cal.filter("trade_flag = 1") if trading else cal
    spans = kept.groupBy("period").agg(F.min("busi_date").alias("b"), F.max("busi_date").alias("e"))
    windows = spans.select("period", F.explode(F.array(
        F.struct(F.lit("current").alias("window"), F.col("b").alias("lo"), F.col("e").alias("hi")),
        F.struct(F.lit("previous").alias("window"), F.add_months("b", -1).alias("lo"), F.add_months("e", -1).alias("hi")),
    )).alias("w")).select("period", "w.*")
    return windows.select("period", "window", F.explode(F.sequence("lo", "hi")).alias("tx_dt"))


def exchange_rebate(rebates: DataFrame, calendar: DataFrame, rules: Mapping[str, str] = REBATE_WINDOWS,
                    trading: bool = True) -> DataFrame:
    """Exchange rebates per account and month, each column counted in its own window."""
    cols = {c: r for c, r in rules.items() if c in rebates.columns}
    w = F.col("window")
    early = F.col("tx_dt") < F.lit(REBATE_CUTOFF).cast("date")
    cond = {"current": w == "current", "previous": w == "previous",
            "before_cutoff": (w == "previous") & early, "both": F.lit(True)}
    total = sum((F.when(cond[r], nz(c)).otherwise(0.0) for c, r in cols.items()), F.lit(0.0))
    return (rebates.join(rebate_days(calendar, trading), "tx_dt").groupBy("period", "fund_account_id")
            .agg(money_sum(total, 4).alias("market_reduct")))


def spread_interest(sett: DataFrame, rates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Interest earned on free balances per account and month.

    The base is rights less the larger of pledge and margin, once for every natural day until
    the next trading day, at the rate in force (percent a year of 360 days).
    """
    carried = (trading_day_map(calendar).filter(F.col("trade_date").isNotNull())
               .groupBy(F.col("trade_date").alias("busi_date")).agg(F.count(F.lit(1)).alias("carried")))
    per_day = carried.join(daily_rates(rates, one_market(calendar), "interest_rate", "begin_date", "end_date"), "busi_date")
    # One factor per day, broadcast: the settlements are shuffled once, after partial sums.
    earned = "(rights - greatest(impawn_money, margin)) * carried * interest_rate / 36000"
    return (sett.join(per_day, "busi_date").groupBy(month_key("busi_date").alias("period"), "fund_account_id")
            .agg(money_sum(earned).alias("interest_income")))


def monthly_retained_fees(sett: DataFrame, calendar: DataFrame) -> DataFrame:
    days = one_market(calendar).filter("trade_flag = 1").select("busi_date")
    return sett.join(days, "busi_date").groupBy(month_key("busi_date").alias("period"), "fund_account_id").agg(
        money_sum(retained_fee()).alias("remain_transfee"))


def brokerage_income(sett: DataFrame, rates: DataFrame, rebates: DataFrame, accounts: DataFrame,
                     calendar: DataFrame) -> DataFrame:
    """Retained fees, interest and exchange rebates per account and month; zero totals dropped."""
    merged = spine_merge({"a": (monthly_retained_fees(sett, calendar), ["remain_transfee"]),
                          "b": (spread_interest(sett, rates, calendar), ["interest_income"]),
                          "c": (exchange_rebate(rebates, calendar), ["market_reduct"])},
                         ["period", "fund_account_id"], 4)
    total = F.round(F.col("a_remain_transfee") + F.col("b_interest_income") + F.col("c_market_reduct"), 4)
    return (merged.withColumn("feature_income_total", total).filter(F.col("feature_income_total") != 0)
            .join(accounts.select("fund_account_id", "branch_id"), "fund_account_id")
            .select(F.col("period").alias("busi_month"), "fund_account_id", "branch_id",
                    F.col("a_remain_transfee").alias("remain_transfee"),
                    F.col("b_interest_income").alias("interest_income"),
                    F.col("c_market_reduct").alias("market_reduct"), "feature_income_total"))


# ---- cooperation and resident staff ------------------------------------------------------------

def net_interest(interest: DataFrame, rates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Interest on accrual balances less what clients and brokers get back, per account and month.

    Rows whose balance and accrual base cancel out carry no interest.
    """
    rows = interest.filter(F.col("today_ri_amt") != -F.col("calint_amt"))
    days = period_calendar(calendar, "month").select("busi_date", "period", "natural_days")
    dated = days.join(daily_rates(rates, one_market(calendar), "interest_rate", "begin_date", "end_date"), "busi_date")
    grouped = rows.join(dated, "busi_date").groupBy("period", "fund_account_id", "calint_days", "interest_rate").agg(
        money_sum("calint_amt").alias("base"), money_sum("int_amt_d").alias("paid"), F.max("natural_days").alias("days"))
    due = F.col("base") * F.col("interest_rate") * F.col("days") / F.nullif("calint_days", F.lit(0)) - F.col("paid")
    return grouped.groupBy("period", "fund_account_id").agg(money_sum(due).alias("interest_clear_income"))


def rebate_payouts(journal: DataFrame) -> DataFrame:
    """Rebates paid out to clients (fund type 3, outgoing), per account and month."""
    return (journal.filter((F.col("fund_type") == "3") & (F.col("fund_direct") == "1"))
            .groupBy(month_key("busi_date").alias("period"), "fund_account_id")
            .agg(money_sum("occur_money").alias("occur_money")))


def _since(facts: DataFrame, starts: DataFrame, value: Column, name: str, date_col: str = "busi_date") -> DataFrame:
    """Monthly sums of ``value`` from each account's start date on."""
    per_day = facts.groupBy("fund_account_id", date_col).agg(money_sum(value).alias(name))
    return (per_day.join(starts, "fund_account_id").filter(F.col(date_col) >= F.col("start"))
            .groupBy(month_key(date_col).alias("period"), "fund_account_id").agg(*sums([name])))


def cooperation_income(agreements: DataFrame, sett: DataFrame, interest: DataFrame, rates: DataFrame, rebates: DataFrame,
                       journal: DataFrame, accounts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Introducing-broker income per branch and month.

    Each account counts from its earliest registration. Agreements repeat an account once per
    service person, so they are reduced to account and share rate first.
    """
    served = agreements.filter(F.col("service_type") == "1")
    starts = served.groupBy("fund_account_id").agg(F.min("regist_date").alias("start"))
    fees = _since(sett, starts, retained_fee(), "remain_transfee")
    keys = ["period", "fund_account_id"]
    extra = spine_merge({"i": (net_interest(interest, rates, calendar), ["interest_clear_income"]),
                         "r": (exchange_rebate(rebates, calendar, COOPERATION_WINDOWS, False), ["market_reduct"]),
                         "p": (rebate_payouts(journal), ["occur_money"])}, keys, 4)
    shares = served.select("fund_account_id", "coope_income_reate").distinct()
    earned = (F.col("remain_transfee") + nz("i_interest_clear_income") + nz("r_market_reduct") - nz("p_occur_money"))
    return (fees.join(extra, keys, "left").join(shares, "fund_account_id")
            .join(accounts.select("fund_account_id", "branch_id"), "fund_account_id", "left")
            .groupBy(F.col("period").alias("month_id"), "branch_id")
            .agg(money_sum(earned * F.col("coope_income_reate"), 4).alias("xt_income")))


def active_relations(relations: DataFrame, prefix: str | None = "ZD") -> DataFrame:
    """Relations in force and approved, of resident staff when ``prefix`` is given."""
    cond = (F.col("rela_sts") == "A") & (F.col("approve_sts") == "0")
    if prefix is not None:
        cond = cond & F.col("broker_id").startswith(prefix)
    return relations.filter(cond)


def resident_income(relations: DataFrame, recon: DataFrame, interest: DataFrame, rates: DataFrame, rebates: DataFrame,
                    journal: DataFrame, accounts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Resident-staff income per branch and month, from the daily fund reconciliation.

    Interest is shared by the relation's percentage; rebates and net retained fees are not.
    """
    served = active_relations(relations)
    starts = served.groupBy("fund_account_id").agg(F.min("st_dt").alias("start"))
    fees = _since(recon, starts, F.col("clear_remain_transfee"), "clear_remain_transfee")
    keys = ["period", "fund_account_id"]
    extra = spine_merge({"i": (net_interest(interest, rates, calendar), ["interest_clear_income"]),
                         "r": (exchange_rebate(rebates, calendar, COOPERATION_WINDOWS, False), ["market_reduct"]),
                         "p": (rebate_payouts(journal), ["occur_money"])}, keys, 4)
    shares = served.groupBy("fund_account_id").agg(F.sum(nz("data_pct")).alias("pct"), F.count(F.lit(1)).alias("rows"))
    earned = (nz("i_interest_clear_income") * F.col("pct")
              + (nz("r_market_reduct") - nz("p_occur_money") + F.col("clear_remain_transfee")) * F.col("rows"))
    return (fees.join(extra, keys, "left").join(shares, "fund_account_id")
            .join(accounts.select("fund_account_id", "branch_id"), "fund_account_id", "left")
            .groupBy(F.col("period").alias("month_id"), "branch_id").agg(money_sum(earned, 4).alias("zd_income")))


def cooperation_summary(agreements: DataFrame, sett: DataFrame, calendar: DataFrame) -> DataFrame:
    """Opening, closing and average equity, retained fees and shared income per branch and month."""
    served = agreements.filter(F.col("service_type") == "1")
    monthly = sett.join(trading_months(calendar), "busi_date").groupBy("period", "fund_account_id").agg(
        *cond_sums({"yes_rights": ("busi_date = first_trade", "yes_rights"), "end_rights": ("busi_date = last_trade", "rights")}),
        money_sum("rights").alias("sum_rights"), money_sum(retained_fee()).alias("fee"), F.max("trade_days").alias("days"))
    members = served.select("fund_account_id", "regist_date", "branch_id").distinct()
    totals = monthly.join(members, "fund_account_id").groupBy("period", "branch_id").agg(
        *sums(["yes_rights", "end_rights", "sum_rights"]), money_sum("fee").alias("remain_transfee"), F.max("days").alias("days"))
    # One row per agreement here, as each carries its own rate.
    shared = (monthly.join(served.select("fund_account_id", "branch_id", "coope_income_reate"), "fund_account_id")
              .groupBy("period", "branch_id").agg(money_sum(F.col("fee") * F.col("coope_income_reate"), 4).alias("coope_income")))
    return totals.join(shared, ["period", "branch_id"], "left").select(
        F.col("period").alias("month_id"), "branch_id", "yes_rights", "end_rights",
        safe_ratio("sum_rights", "days").alias("avg_rights"), "remain_transfee", "coope_income")


# ---- own investments ---------------------------------------------------------------------------

COST_ACCOUNT, CHANGE_ACCOUNT = "11010199", "11010201"


def investment_tracking(projects: DataFrame, results: DataFrame, balances: DataFrame, departments: DataFrame,
                        month_ends: DataFrame) -> DataFrame:
    """Own-money investments by month: begin and end value, income, cost, days held and yearly rate.

    ``results`` and ``balances`` are monthly rows per product name (and ledger account).
    ``month_ends`` maps ``account_period`` to the month's last day.
    """
    keys = ["project_name", "account_period"]
    res = results.groupBy(*keys).agg(*sums(["total_balance", "changes_begin_value", "changes_end_value",
                                            "investment_income", "total_cost"]))
    cost, change = F.col("account_code") == COST_ACCOUNT, F.col("account_code") == CHANGE_ACCOUNT
    bal = balances.groupBy(*keys).agg(
        money_sum(F.when(cost, F.col("local_end_balance"))).alias("initial_investment_money"),
        money_sum(F.when(cost | change, F.col("local_end_balance"))).alias("month_end_market"),
        money_sum(F.when(change, F.col("local_end_balance"))).alias("change_end"),
        money_sum(F.when(change, F.col("local_begin_balance"))).alias("change_begin"),
        F.max(cost.cast("int")).alias("has_cost"), F.max(change.cast("int")).alias("has_change"))
    monthly = res.join(bal, keys)
    # At most twelve rows per project and year.
    year = Window.partitionBy("project_name", F.substring("account_period", 1, 4)).orderBy("account_period")
    january = F.substring("account_period", 5, 2) == "01"

    def in_january(c: Column) -> Column:
        return nz(F.max(F.when(january, c)).over(year))

    cost_part, change_part = F.col("has_cost") == 1, F.col("has_change") == 1
    begin = F.when(cost_part, F.col("total_balance")).otherwise(0.0) + F.when(change_part, F.col("changes_begin_value")).otherwise(0.0)
    end = F.when(cost_part, F.col("total_balance")).otherwise(0.0) + F.when(change_part, F.col("changes_end_value")).otherwise(0.0)
    earned = F.sum(F.when(change_part, F.col("investment_income")).otherwise(0.0)).over(year)
    out = monthly.select(
        *keys, "initial_investment_money", "month_end_market", in_january(begin).alias("year_begin_net_investment"),
        end.alias("month_end_net_investment"),
        F.round(F.col("change_end") - in_january(F.col("change_end")) + earned, 2).alias("investment_income"),
        F.round(F.col("change_end") - F.col("change_begin") + F.when(change_part, F.col("investment_income")).otherwise(0.0), 2)
        .alias("comprehensive_income"),
        F.when(cost_part, F.col("total_cost")).otherwise(0.0).alias("cost"))
    names = departments.groupBy("project_id").agg(group_concat("recommend_depart").alias("recommend_department"))
    held = F.datediff(F.least("end_date", "month_end"), F.col("begin_date")) + 1
    return (out.join(projects, "project_name").join(month_ends, "account_period").join(names, "project_id", "left")
            .select(F.col("account_period").alias("busi_month"), "project_id", "project_name", "strategy_type", "recommend_department",
                    held.alias("investment_days"), "year_begin_net_investment", "month_end_net_investment",
                    "initial_investment_money", "month_end_market", "comprehensive_income", "investment_income", "cost",
                    F.when((F.col("cost") != 0) & (held > 0), F.col("investment_income") / F.col("cost") / held).alias("year_composite_rate")))


# ---- staff -------------------------------------------------------------------------------------

def relation_spans(relations: DataFrame) -> DataFrame:
    """Distinct validity spans per account."""
    return relations.select("fund_account_id", F.col("st_dt").alias("lo"), F.col("end_dt").alias("hi")).distinct()


def staff_marketing(relations: DataFrame, sett: DataFrame, trades: DataFrame, accounts: DataFrame, branch_map: DataFrame,
                    calendar: DataFrame, equity_shares: DataFrame | None = None) -> DataFrame:
    """Resident-staff clients' equity and turnover per unit and month, weighted by share.

    A fact counts while a relation of its account is valid. ``equity_shares`` adds the average
    equity credited through funds of funds (`fund_of_funds_shares`).
    """
    served = active_relations(relations)
    spans = relation_spans(served)
    days = trading_months(calendar)

    def within(facts: DataFrame, measures: Sequence[str]) -> DataFrame:
        per_day = facts.groupBy("fund_account_id", "busi_date").agg(*sums(measures))
        return (per_day.join(spans, "fund_account_id").filter(F.col("busi_date").between(F.col("lo"), F.col("hi")))
                .join(days, "busi_date"))

    equity = within(sett, ["rights"]).groupBy("period", "fund_account_id").agg(
        money_sum(F.when(F.col("busi_date") == F.col("last_trade"), F.col("rights"))).alias("end_rights"),
        money_sum("rights").alias("sum_rights"))
    turnover = within(trades, ["done_amt", "done_sum"]).groupBy("period", "fund_account_id").agg(
        *sums(["done_amt", "done_sum"]))
    months = days.groupBy("period").agg(F.max("trade_days").alias("days"))
    both = spine_merge({"e": (equity, ["end_rights", "sum_rights"]), "t": (turnover, ["done_amt", "done_sum"])},
                       ["period", "fund_account_id"])
    pct = served.groupBy("fund_account_id").agg(F.sum(F.coalesce("data_pct", F.lit(1.0))).alias("pct"))
    org = branch_map.filter(F.col("oa_branch_id").isNotNull()).select(F.col("ctp_branch_id").alias("branch_id"), "oa_branch_id")
    placed = both.join(pct, "fund_account_id").join(accounts.select("fund_account_id", "branch_id"), "fund_account_id").join(org, "branch_id")
    out = placed.groupBy("period", "oa_branch_id").agg(
        F.count(F.lit(1)).alias("clients"),
        *[money_sum(F.col(c) * F.col("pct"), 4).alias(n) for c, n in
          (("e_end_rights", "end_rights"), ("e_sum_rights", "sum_rights"), ("t_done_amt", "done_amount"), ("t_done_sum", "done_money"))])
    out = out.join(months, "period").withColumn("avg_rights", safe_ratio("sum_rights", "days"))
    if equity_shares is not None:
        extra = equity_shares.groupBy("period", "oa_branch_id").agg(money_sum("sum_avg_rights", 4).alias("__fof"))
        out = out.join(extra, ["period", "oa_branch_id"], "left").withColumn("avg_rights", F.col("avg_rights") + nz("__fof"))
    return out.select(F.col("period").alias("month_id"), "oa_branch_id", "clients", "end_rights", "avg_rights", "done_amount", "done_money")
