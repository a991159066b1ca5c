"""Fund reconciliation by day and by month.

Both reports cover every period of the input in one job. A run for one month is the same
call on inputs filtered to it (`sources.tables.day_range`), which prunes the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import col_or_zero, cond_sums, money_sum, nz, safe_ratio, sums
from ..operators.calendar import expand_natural_days, period_calendar

# Settlement measures. Flows belong to a trading day and are zero on the days
# it is carried over; stocks are balances and are carried.
FLOWS = (
    "yes_rights fund_in strikeactreceivsum fund_out strikeactpaysum fund_impawn_in fund_impawn_out "
    "lastfundmortgagein lastfundmortgageout yes_impawn_money opt_premium_income opt_premium_pay "
    "transfee delivery_transfee strikefee performfee market_transfee market_delivery_transfee "
    "market_strikefee market_performfee today_profit hold_profit hold_profit_f close_profit "
    "drop_profit_f fund_impawn_margin socrt_openfee settlementfee buy_opt_market_value "
    "sell_opt_market_value market_deposit optstrike_profit margin market_margin strike_credit "
    "credit execute_transfee market_execute_transfee add_fee1 add_fee2").split()
STOCKS = ["rights", "impawn_money", "open_pre_money"]
TRADES = ["done_amount", "done_money", "done_amount_pj", "done_money_pj"]
# Investor-protection levy when the fee table names none, per unit of turnover.
DEFAULT_LEVY = 5.5 / 100_000_000
KEYS = ["branch_id", "client_id", "fund_account_id", "sett_type", "money_type"]


def levy_rate(fees: DataFrame) -> DataFrame:
    """One row ``levy``: the highest fee in force (per hundred million), or the default."""
    active = (F.col("fee_type") == "1003") & (F.col("use_status") == "0") & (F.col("data_level") == "1")
    return fees.filter(active).agg(
        F.coalesce(F.max("fee") / 100_000_000, F.lit(DEFAULT_LEVY)).alias("levy"))


def levy_column(levy: float | DataFrame) -> Column:
    """A rate, or `levy_rate`'s frame as a scalar subquery: read with the report, by no job of its own."""
    return levy.select("levy").scalar() if isinstance(levy, DataFrame) else F.lit(levy)


def daily_trades(hold_balance: DataFrame) -> DataFrame:
    """Traded and same-day-closed volume and turnover per account and day."""
    return hold_balance.groupBy("busi_date", "fund_account_id", "money_type").agg(
        money_sum("done_amt").alias("done_amount"), money_sum("done_sum").alias("done_money"),
        money_sum("close_amount_today").alias("done_amount_pj"),
        money_sum("close_money_today").alias("done_money_pj"))


def net_retained_fees(values: DataFrame, day: str = "tx_dt", investor: str = "investor_id") -> DataFrame:
    """Retained fee net of rebates, returns and software charges, per account and day."""
    net = nz("subsistence_fee_amt") - nz("fd_amt") - nz("return_amt") - nz("soft_amt")
    return values.groupBy(F.col(day).alias("busi_date"), F.col(investor).alias("fund_account_id")).agg(
        money_sum(net).alias("clear_remain_transfee"))


def _per_day(sett: DataFrame, trades: DataFrame, fees: DataFrame | None) -> DataFrame:
    """Settlement summed to its key, with that day's trades and net fees beside it."""
    base = sett.selectExpr("busi_date", *KEYS, *[col_or_zero(sett, m) for m in [*FLOWS, *STOCKS]])
    # An account has about one row a day: sums before the shuffle would fill memory with wide rows and save none. Dealt by
    # account and day, the rows are shuffled once for the sums and the join to the fees.
    day = (base.repartition("busi_date", "fund_account_id").groupBy("busi_date", *KEYS)
           .agg(*sums([*FLOWS, *STOCKS])))
    if fees is not None:
        day = day.join(fees, ["busi_date", "fund_account_id"], "left")
    else:
        day = day.withColumn("clear_remain_transfee", F.lit(0.0))
    day = day.join(trades, ["busi_date", "fund_account_id", "money_type"], "left")
    return day.fillna(0.0, [*TRADES, "clear_remain_transfee"])


def _fees(prefix: str):
    return (F.col(f"{prefix}transfee") + F.col(f"{prefix}delivery_transfee") + F.col(f"{prefix}strikefee"))


def daily_fund_reconciliation(sett: DataFrame, calendar: DataFrame, trades: DataFrame,
                              fees: DataFrame | None = None, levy: float | DataFrame = DEFAULT_LEVY) -> DataFrame:
    """One row per account key and natural day.

    Non-trading days carry the balances and have no flows, except ``yes_rights``, which is
    the previous natural day's ``rights``.
    """
    day = _per_day(sett, trades, fees)
    days = expand_natural_days(day, calendar, [*FLOWS, *TRADES, "clear_remain_transfee"], STOCKS, KEYS)
    end_rights = F.col("rights") * F.col("trade_flag")
    return days.select(
        "n_busi_date", "trade_flag", *KEYS,
        F.when(end_rights > 0, 0).when(end_rights == 0, 1).otherwise(2).alias("rights_flag"),
        "rights", end_rights.alias("end_rights"),
        # The day before a carried day is the trading day itself or was carried from it, so its rights are this row's.
        F.when(F.col("trade_flag") == 0, F.when(F.col("follows"), F.col("rights")).otherwise(F.lit(0.0)))
        .otherwise(F.col("yes_rights")).alias("yes_rights"),
        F.round(F.col("fund_in") + F.col("strikeactreceivsum"), 2).alias("fund_in"),
        F.round(F.col("fund_out") + F.col("strikeactpaysum"), 2).alias("fund_out"),
        F.round(_fees(""), 2).alias("transfee"), F.round(_fees("market_"), 2).alias("market_transfee"),
        F.round(_fees("") - _fees("market_"), 2).alias("remain_transfee"),
        (F.col("done_money") * levy_column(levy)).alias("bzjj"),
        safe_ratio("margin", end_rights).alias("risk_degree1"),
        safe_ratio("market_margin", end_rights).alias("risk_degree2"),
        F.round(F.col("open_pre_money") - F.col("impawn_money"), 2).alias("pre_impawn"),
        F.round((F.col("rights") - F.col("market_margin")) * F.col("trade_flag"), 2).alias("market_open_pre_money"),
        F.col("transfee").alias("trade_transfee"), F.col("market_transfee").alias("market_trade_transfee"),
        F.round(F.col("transfee") - F.col("market_transfee"), 2).alias("remain_trade_transfee"),
        F.col("hold_profit").alias("hold_profit_d"), F.col("close_profit").alias("close_profit_d"),
        F.col("drop_profit_f").alias("close_profit_f"), F.col("socrt_openfee").alias("jingshoufei"),
        F.col("settlementfee").alias("jiesuanfei"), F.col("lastfundmortgagein").alias("fund_impawn_in_yes"),
        F.col("lastfundmortgageout").alias("fund_impawn_out_yes"),
        *[F.col(c) for c in _PASSED], *TRADES, "clear_remain_transfee")


_RENAMED = {"yes_rights", "fund_in", "fund_out", "strikeactreceivsum", "strikeactpaysum", "transfee",
            "market_transfee", "hold_profit", "close_profit", "drop_profit_f", "socrt_openfee",
            "settlementfee", "lastfundmortgagein", "lastfundmortgageout"}
_PASSED = [c for c in [*FLOWS, "impawn_money", "open_pre_money"] if c not in _RENAMED]

# Measures reported at the period's last trading day, and summed over it.
AT_CLOSE = ("fund_impawn_in fund_impawn_out open_pre_money impawn_money market_deposit "
            "buy_opt_market_value sell_opt_market_value margin market_margin strike_credit credit").split()
OVER_PERIOD = ("opt_premium_income opt_premium_pay today_profit hold_profit hold_profit_f close_profit "
               "drop_profit_f fund_impawn_margin delivery_transfee market_delivery_transfee "
               "optstrike_profit strikefee market_strikefee performfee market_performfee "
               "execute_transfee market_execute_transfee add_fee1 add_fee2 "
               "done_amount done_money done_amount_pj done_money_pj clear_remain_transfee").split()


def monthly_fund_reconciliation(sett: DataFrame, calendar: DataFrame, trades: DataFrame,
                                fees: DataFrame | None = None, levy: float | DataFrame = DEFAULT_LEVY,
                                grain: str = "month") -> DataFrame:
    """One row per account key and period: opening, closing, highest and average balances, flows.

    Balances are averaged over trading days and over natural days. The carried days enter as
    weights, so the fact rows are not multiplied.
    """
    day = _per_day(sett, trades, fees)
    cal = period_calendar(calendar, grain).filter(F.col("trade_date").isNotNull())
    per_date = cal.groupBy(F.col("trade_date").alias("busi_date"), "period").agg(
        F.count(F.lit(1)).alias("w"), F.max("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"), F.max("trade_days").alias("td"),
        F.max("natural_days").alias("nd"),
        F.max(F.when(F.col("busi_date") == F.col("trade_date"), 1).otherwise(0)).alias("own"))
    j = day.join(per_date, "busi_date")
    own, opening, closing = "own = 1", "own = 1 AND busi_date = first_trade", "own = 1 AND busi_date = last_trade"
    fee = "{0}transfee + {0}delivery_transfee + {0}strikefee"
    z = F.col
    agg = j.groupBy("period", *KEYS).agg(
        *cond_sums({
            "yes_rights": (opening, "yes_rights"), "end_rights": (closing, "rights"), "__rt": (own, "rights"),
            "__ot": (own, "open_pre_money"), "__it": (own, "impawn_money"), "__md": (own, "market_deposit"),
            "jingshoufei": (own, "socrt_openfee"), "jiesuanfei": (own, "settlementfee"),
            "begin_yes_impawn_money": (opening, "yes_impawn_money"), "fund_impawn_in_yes": (opening, "lastfundmortgagein"),
            "fund_impawn_out_yes": (opening, "lastfundmortgageout"), "fund_in": (own, "fund_in + strikeactreceivsum"),
            "fund_out": (own, "fund_out + strikeactpaysum"), "transfee": (own, fee.format("")),
            "market_transfee": (own, fee.format("market_")), "trade_transfee": (own, "transfee"),
            "market_trade_transfee": (own, "market_transfee"),
            **{f"end_{c}": (closing, c) for c in AT_CLOSE}, **{c: (own, c) for c in OVER_PERIOD}}),
        money_sum("rights * w").alias("__rn"), money_sum("open_pre_money * w").alias("total_open_pre_money"),
        money_sum("impawn_money * w").alias("total_impawn_money"),
        F.max("rights").alias("max_rights"), F.max("td").alias("trade_days"), F.max("nd").alias("natural_days"))
    return agg.select(
        "period", *KEYS, "yes_rights", "end_rights", "max_rights",
        safe_ratio("__rt", "trade_days").alias("avg_trade_rights"),
        safe_ratio("__rn", "natural_days").alias("avg_nature_rights"),
        safe_ratio("__md", "trade_days").alias("avg_trade_market_deposit"),
        "fund_in", "fund_out", "transfee", "market_transfee",
        F.round(z("transfee") - z("market_transfee"), 2).alias("remain_transfee"),
        "trade_transfee", "market_trade_transfee",
        F.round(z("trade_transfee") - z("market_trade_transfee"), 2).alias("remain_trade_transfee"),
        (z("done_money") * levy_column(levy)).alias("bzjj"),
        safe_ratio("end_margin", "end_rights").alias("risk_degree1"),
        safe_ratio("end_market_margin", "end_rights").alias("risk_degree2"),
        F.round(z("end_impawn_money") - z("begin_yes_impawn_money"), 2).alias("fund_impawn_chg"),
        F.round(z("end_open_pre_money") - z("end_impawn_money"), 2).alias("end_pre_impawn"),
        F.round(z("end_buy_opt_market_value") - z("end_sell_opt_market_value"), 2).alias("end_opt_market_value"),
        z("__ot").alias("open_pre_money"), z("__it").alias("impawn_money"),
        F.round(z("__ot") - z("__it"), 2).alias("pre_impawn"),
        "total_open_pre_money", "total_impawn_money",
        F.round(z("total_open_pre_money") - z("total_impawn_money"), 2).alias("total_pre_impawn"),
        "begin_yes_impawn_money", "fund_impawn_in_yes", "fund_impawn_out_yes", "jingshoufei", "jiesuanfei",
        *[f"end_{c}" for c in AT_CLOSE], *OVER_PERIOD, "trade_days", "natural_days")
