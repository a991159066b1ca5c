"""Trade statistics by day or month: five components merged on one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import delivery_month
from ..functions.measures import cents_sql
from ..operators.calendar import period_calendar, trading_day_map
from ..operators.spine import spine_merge, spread
from .settlement import DEFAULT_LEVY, levy_column

KEYS = ["period", "client_id", "branch_id", "fund_account_id", "money_type", "trade_type",
        "trade_prop", "security_id"]
# Rows are dealt by contract, and those of one contract to so many cells, so that contracts are joined without a shuffle of the sums.
CELLS = 8
DEALT = {"security_id": "security_id", "__cell": f"pmod(hash({', '.join(k for k in KEYS if k != 'security_id')}), {CELLS})"}
EXCHANGE_WITHOUT_PERFORMANCE = "CFFEX"


def _period(df: DataFrame, calendar: DataFrame, grain: str, date_col: str = "busi_date") -> DataFrame:
    """Facts of trading days with their period, its last trading day and its trading-day count."""
    days = (period_calendar(calendar, grain).filter("trade_flag = 1")
            .select(F.col("busi_date").alias(date_col), "period", "last_trade", "trade_days"))
    return df.join(days, date_col)


# Each component is a projection: a row's key and what it adds to each measure. Nothing is
# summed here; the spine sums the components, each on its own few measures.

def _rows(df: DataFrame, measures: dict[str, str]) -> tuple[DataFrame, list[str]]:
    return df.selectExpr(*KEYS, *[f"{e} AS {n}" for n, e in measures.items()]), list(measures)


def _when(cond: str, value: str, other: str = "NULL") -> str:
    return f"CASE WHEN {cond} THEN {value} ELSE {other} END"


MARGINS = (("margin_tj", "1"), ("margin_tl", "2"), ("margin_tb", "3"))


def open_positions(hold_detail: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """Positions at the period's last trading day, and every day's amount for the average. Option values of type 12; the fees have those of 21."""
    last, money = "busi_date = last_trade", "amount * sett_price * hand_amount"
    option = f"{last} AND trade_type = '12'"
    at_end = {"hold_amount": "amount", "hold_money": money, **{c: c for c in (
        "hold_profit_bydate", "hold_profit_bytrade", "margin", "market_margin")}}
    return _rows(_period(hold_detail, calendar, grain), {
        **{n: _when(last, v) for n, v in at_end.items()}, "amount_all": "amount",
        "buy_hold_money_qq": _when(f"{option} AND bs_direction = '0'", money),
        "sell_hold_money_qq": _when(f"{option} AND bs_direction = '1'", money)})


def position_fees(hold_balance: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    fee = "coalesce({0}transfee, 0) + coalesce({0}settfee, 0) + coalesce({0}holdmovefee, 0)"
    option = "trade_type = '21'"
    return _rows(_period(hold_balance, calendar, grain), {
        "transfee": fee.format(""), "market_transfee": fee.format("market_"), "total_profit": "today_profit",
        **{c: c for c in ("close_profit_bydate", "close_profit_bytrade", "hold_profit_bytrade")},
        "buy_hold_money_qq": _when(f"{option} AND bs_direction = '0'", "market_value"),
        "sell_hold_money_qq": _when(f"{option} AND bs_direction = '1'", "market_value"),
        "margin": "margin", "hold_amount_buy": _when("bs_direction = '0'", "hold_amount"),
        "hold_amount_sell": _when("bs_direction = '1'", "hold_amount"),
        "done_amount": "done_amt", "done_money": "done_sum", "done_amount_pj": "close_amount_today",
        "done_money_pj": "close_money_today"})


def fill_activity(done: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """Fills. Traded days are kept as a bit per day of the month, counted after the merge."""
    same_day, forced, premium = "trade_order = '3'", "force_flag = '1'", "trade_type <> '11'"
    return _rows(_period(done, calendar, grain), {
        "days": "shiftleft(1L, dayofmonth(busi_date))",
        **{c: c for c in ("socrt_openfee", "settlementfee", "add_fee1", "add_fee2")},
        "transfee_pj": _when(same_day, "transfee"), "market_transfee_pj": _when(same_day, "market_transfee"),
        "remain_transfee_pj": _when(same_day, "transfee - market_transfee"),
        "opt_premium_pay": _when(f"{premium} AND bs_direction = '0'", "done_money"),
        "opt_premium_income": _when(f"{premium} AND bs_direction = '1'", "done_money"),
        "done_amount_qp": _when(forced, "done_amount"), "done_money_qp": _when(forced, "done_money"),
        "force_number": _when(forced, "1")})


def deliveries(delivery: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """Deliveries. A period for which the newer clearing system supplied any row is dated by settlement, others by business day.

    The period that decides is the one a delivery settles in; the rows that decide it are those of its business days.
    """
    periods = period_calendar(calendar, grain).select("busi_date", F.col("period").alias("__period"))
    newer = (delivery.filter("data_source = 'CTP2'").join(periods, "busi_date").select("__period").distinct()
             .withColumn("__newer", F.lit(True)))
    settled = delivery.join(periods.withColumnRenamed("busi_date", "sett_date"), "sett_date", "left").join(newer, "__period", "left")
    dated = settled.withColumn("__day", F.expr("CASE WHEN __newer THEN sett_date ELSE busi_date END"))
    last = "busi_date = last_trade"
    return _rows(_period(dated, calendar, grain, "__day"), {
        **{c: c for c in ("transfee", "market_transfee", "done_amt")}, "remain_transfee": "transfee - market_transfee",
        "delivery_amount": "pay_amount", "margin": _when(last, "margin"), "market_margin": _when(last, "market_margin")})


SIDES = {"strikefee": "fee", "market_strikefee": "market_fee", "strike_qty": "qty"}


def exercises(execute: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """Option exercise and performance, by side.

    Exchange options (type 21) are booked on the next trading day; commodity options (type 12)
    come with separate exercise and performance fees. Which side counts as exercise depends on
    the contract's exchange and is settled after the merge.
    """
    nxt = trading_day_map(calendar, 1).selectExpr("busi_date", "trade_date AS __next")
    rows = (execute.filter("trade_type = '21' OR (trade_type = '12' AND strike_type = '0')").join(nxt, "busi_date")
            .withColumn("__day", F.expr("CASE WHEN trade_type = '21' THEN __next ELSE busi_date END")))
    frozen = "trade_type = '21' AND __day = last_trade"
    return _rows(_period(rows, calendar, grain, "__day"), {
        "transfee": "strikefee", "market_transfee": "market_strikefee", "remain_transfee": "strikefee - market_strikefee",
        **{f"{n}_{side}": _when(f"bs_direction = '{d}'", c) for c, n in SIDES.items() for side, d in (("buy", "0"), ("sell", "1"))},
        "execute": "execute_transfee", "market_execute": "market_execute_transfee", "perform": "performfee",
        "market_perform": "market_performfee", "optstrike_profit": "optstrike_profit",
        "strikefrozenmargin": _when(frozen, "strikefrozenmargin"),
        "exchstrikefrozenmargin": _when(frozen, "exchstrikefrozenmargin")})


def expiries(execute: DataFrame, securities: DataFrame, calendar: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """Commodity options exercised on their contract's delivery date: an equi-join on both."""
    ends = (securities.filter("delivery_date IS NOT NULL")
            .selectExpr("security_id", "to_date(delivery_date, 'yyyyMMdd') AS busi_date"))
    rows = execute.filter("trade_type = '12' AND strike_type = '0'").join(ends, ["security_id", "busi_date"])
    return _rows(_period(rows, calendar, grain), {
        "strike_qty_dq": "strike_qty", "strike_money_dq": "strike_qty * strike_price * hand_amount"})


def trade_statistics(hold_detail: DataFrame, hold_balance: DataFrame, done: DataFrame, delivery: DataFrame,
                     execute: DataFrame, securities: DataFrame, accounts: DataFrame, calendar: DataFrame,
                     grain: str = "day", levy: float | DataFrame = DEFAULT_LEVY) -> DataFrame:
    """All five components on their common key, with totals, contract month and account columns.

    Contracts and accounts are joined once, to the sums. ``grain`` is ``day``, ``week`` or ``month``; ``levy`` is a rate or
    the one-row frame of `settlement.levy_rate`.
    """
    if grain not in ("day", "week", "month"):
        raise ValueError("trade statistics are by day, week or month")
    merged = spine_merge({
        "h": open_positions(hold_detail, calendar, grain), "f": position_fees(hold_balance, calendar, grain),
        "d": fill_activity(done, calendar, grain), "v": deliveries(delivery, calendar, grain),
        "x": exercises(execute, calendar, grain), "e": expiries(execute, securities, calendar, grain)},
        KEYS, masks=["d_days"], fine=True, dealt=DEALT)
    periods = period_calendar(calendar, grain).select("period", "trade_days").distinct()
    merged = merged.join(periods, "period")
    month = delivery_month("contract_code", "delivery_year", "delivery_month", "delivery_date", "end_delivery_date")
    dims = securities.select("security_id", "market_id", "product_id", month.alias("deliv_date"))
    own = accounts.select("fund_account_id", "client_type", "open_date")

    def same(prefix: str, *names: str) -> list[str]:
        return [f"{prefix}_{n} AS {n}" for n in names]

    def by_kind(name: str) -> str:
        return f"CASE trade_type WHEN '21' THEN f_{name} WHEN '12' THEN h_{name} ELSE 0D END AS {name}"

    one_book = f"market_id = '{EXCHANGE_WITHOUT_PERFORMANCE}'"

    def xq(own: str, shared: str, name: str = "") -> str:
        """Exercise: type 21 takes the buyer's side, and the seller's where it is not performance."""
        e = f"CASE WHEN trade_type = '21' THEN {cents_sql(f"x_{shared}_buy + CASE WHEN {one_book} THEN x_{shared}_sell ELSE 0D END")} ELSE x_{own} END"
        return f"{e} AS {name}" if name else e

    def ly(own: str, shared: str, name: str) -> str:
        return f"CASE WHEN trade_type = '21' THEN CASE WHEN {one_book} THEN 0D ELSE x_{shared}_sell END ELSE x_{own} END AS {name}"

    fees = "f_{0} + v_{0} + x_{0}"
    return (merged.join(spread(dims, "__cell", CELLS), ["security_id", "__cell"]).join(own, "fund_account_id", "left").selectExpr(
        *KEYS, "market_id", "product_id", "deliv_date", "client_type", "open_date",
        *same("h", "hold_amount", "hold_money", "hold_profit_bydate", "hold_profit_bytrade"),
        "round(h_amount_all / trade_days, 8) AS hold_amount_avg", "CAST(bit_count(d_days) AS DOUBLE) AS have_trade_num",
        by_kind("buy_hold_money_qq"), by_kind("sell_hold_money_qq"),
        *[f"{cents_sql(f'h_{n} + v_{n}')} AS {n}" for n in ("margin", "market_margin")],
        *[f"{cents_sql(_when(f"trade_prop = '{p}'", 'f_margin + v_margin', '0D'))} AS {n}" for n, p in MARGINS],
        *same("d", "transfee_pj", "market_transfee_pj", "remain_transfee_pj", "opt_premium_income",
              "opt_premium_pay", "add_fee1", "add_fee2", "done_amount_qp", "done_money_qp", "force_number"),
        "d_socrt_openfee AS jingshoufei", "d_settlementfee AS jiesuanfei",
        f"{cents_sql('d_opt_premium_income - d_opt_premium_pay')} AS opt_premium_income_pay",
        *same("f", "done_amount", "done_amount_pj", "done_money", "done_money_pj", "close_profit_bydate",
              "close_profit_bytrade", "hold_amount_buy", "hold_amount_sell", "total_profit"),
        f"{cents_sql('f_hold_profit_bytrade + f_close_profit_bytrade')} AS float_profit",
        *[f"v_{n} AS deliv_{n}" for n in ("transfee", "market_transfee", "remain_transfee", "margin", "market_margin")],
        *same("v", "delivery_amount", "done_amt"),
        xq("execute", "fee", "transfee_xq"), xq("market_execute", "market_fee", "market_transfee_xq"),
        ly("perform", "fee", "transfee_ly"), ly("market_perform", "market_fee", "market_transfee_ly"),
        xq("qty_buy", "qty", "strike_qty_xq"), ly("qty_sell", "qty", "strike_qty_ly"),
        *same("e", "strike_qty_dq", "strike_money_dq"),
        *same("x", "optstrike_profit", "strikefrozenmargin", "exchstrikefrozenmargin"),
        f"{cents_sql(xq('execute', 'fee') + ' - ' + xq('market_execute', 'market_fee'))} AS remain_transfee_xq",
        "f_transfee AS trade_transfee", "f_market_transfee AS market_trade_transfee",
        f"{cents_sql('f_transfee - f_market_transfee')} AS trade_remain_transfee",
        f"{cents_sql(fees.format('transfee'))} AS total_transfee",
        f"{cents_sql(fees.format('market_transfee'))} AS total_market_transfee",
        f"{cents_sql('f_transfee - f_market_transfee + v_remain_transfee + x_remain_transfee')} AS total_remain_transfee",
        f"{cents_sql('f_total_profit - ' + cents_sql(fees.format('transfee')))} AS clear_profit")
            .withColumn("bzjj", F.col("done_money") * levy_column(levy)))
