"""Fund reconciliation and trade statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import query
from catalog.standins import with_
from marginbook.functions import dates as D
from marginbook.plans import settlement, trades

LEVY = "(SELECT levy FROM levy)"
# Every measure of the settlement table.
MEASURES = ("rights yes_rights fund_in fund_out impawn_money margin market_margin open_pre_money today_profit transfee market_transfee "
            "delivery_transfee market_delivery_transfee strikefee market_strikefee").split() + S.MORE_SETT
SETT_DAY = f"""
  SELECT busi_date, branch_id, client_id, fund_account_id, sett_type, money_type, {", ".join(f"round(sum({m}), 2) AS {m}" for m in MEASURES)}
  FROM wide_sett GROUP BY ALL"""
TRADE_DAY = """
  SELECT busi_date, fund_account_id, round(sum(done_amt), 2) AS done_amount, round(sum(done_sum), 2) AS done_money,
         round(sum(close_amount_today), 2) AS done_amount_pj, round(sum(close_money_today), 2) AS done_money_pj FROM fills GROUP BY 1, 2"""
FEE_DAY = """
  SELECT busi_date, fund_account_id, round(sum(transfee - market_transfee - strikefee - delivery_transfee), 2) AS net_fee
  FROM client_sett GROUP BY 1, 2"""
ADDED = "coalesce(t.done_amount, 0) AS done_amount, coalesce(t.done_money, 0) AS done_money, coalesce(t.done_amount_pj, 0) AS done_amount_pj, coalesce(t.done_money_pj, 0) AS done_money_pj, coalesce(f.net_fee, 0) AS net_fee"
RECONCILED = ("client_sett", "wide_sett", "fills", "daymap", "months", "levy")


def investor_values(spark, sf):
    return S.client_sett(spark, sf).select(
        F.col("busi_date").alias("tx_dt"), F.col("fund_account_id").alias("investor_id"),
        F.col("transfee").alias("subsistence_fee_amt"), F.col("market_transfee").alias("fd_amt"),
        F.col("strikefee").alias("return_amt"), F.col("delivery_transfee").alias("soft_amt"))


def _inputs(spark, sf):
    return (S.wide_sett(spark, sf), S.calendar(spark, sf), settlement.daily_trades(S.fills(spark, sf)),
            settlement.net_retained_fees(investor_values(spark, sf)), settlement.levy_rate(S.fees(spark, sf)))


def _flagged(names: str) -> str:
    return ", ".join(f"e.{c} * e.flag AS {n}" for c, n in ((x.split(":") * 2)[:2] for x in names.split()))


@query("daily_fund_reconciliation", with_(*RECONCILED, s=SETT_DAY, t=TRADE_DAY, f=FEE_DAY, e=f"""
  SELECT d.busi_date AS n_busi_date, d.trade_flag AS flag, s.*, {ADDED}
  FROM s LEFT JOIN t ON s.busi_date = t.busi_date AND s.fund_account_id = t.fund_account_id
  LEFT JOIN f ON s.busi_date = f.busi_date AND s.fund_account_id = f.fund_account_id
  JOIN daymap d ON d.trade_date = s.busi_date""") + f"""
SELECT strftime(e.n_busi_date, '%Y%m%d') AS n_busi_date, e.flag AS trade_flag, e.branch_id, e.client_id, e.fund_account_id, e.sett_type, e.money_type,
       CASE WHEN e.rights * e.flag > 0 THEN 0 WHEN e.rights * e.flag = 0 THEN 1 ELSE 2 END AS rights_flag, e.rights, e.rights * e.flag AS end_rights,
       CASE WHEN e.flag = 0 THEN coalesce(p.rights, 0) ELSE e.yes_rights END AS yes_rights,
       round((e.fund_in + e.strikeactreceivsum) * e.flag, 2) AS fund_in, round((e.fund_out + e.strikeactpaysum) * e.flag, 2) AS fund_out,
       round((e.transfee + e.delivery_transfee + e.strikefee) * e.flag, 2) AS transfee,
       round((e.market_transfee + e.market_delivery_transfee + e.market_strikefee) * e.flag, 2) AS market_transfee,
       round((e.transfee + e.delivery_transfee + e.strikefee - e.market_transfee - e.market_delivery_transfee - e.market_strikefee) * e.flag, 2) AS remain_transfee,
       e.done_money * e.flag * {LEVY} AS bzjj,
       CASE WHEN e.rights * e.flag <> 0 THEN e.margin * e.flag / (e.rights * e.flag) ELSE 0 END AS risk_degree1,
       CASE WHEN e.rights * e.flag <> 0 THEN e.market_margin * e.flag / (e.rights * e.flag) ELSE 0 END AS risk_degree2,
       round(e.open_pre_money - e.impawn_money, 2) AS pre_impawn, round((e.rights - e.market_margin) * e.flag, 2) AS market_open_pre_money,
       round((e.transfee - e.market_transfee) * e.flag, 2) AS remain_trade_transfee, e.impawn_money, e.open_pre_money, e.net_fee * e.flag AS clear_remain_transfee,
       {_flagged("""transfee:trade_transfee market_transfee:market_trade_transfee hold_profit:hold_profit_d close_profit:close_profit_d
                 drop_profit_f:close_profit_f socrt_openfee:jingshoufei settlementfee:jiesuanfei lastfundmortgagein:fund_impawn_in_yes
                 lastfundmortgageout:fund_impawn_out_yes fund_impawn_in fund_impawn_out yes_impawn_money opt_premium_income opt_premium_pay
                 delivery_transfee strikefee performfee market_delivery_transfee market_strikefee market_performfee today_profit hold_profit_f
                 fund_impawn_margin buy_opt_market_value sell_opt_market_value market_deposit optstrike_profit margin market_margin strike_credit
                 credit execute_transfee market_execute_transfee add_fee1 add_fee2 done_amount done_money done_amount_pj done_money_pj""")}
FROM e LEFT JOIN e p ON p.n_busi_date = e.n_busi_date - 1 AND p.branch_id = e.branch_id
  AND p.fund_account_id = e.fund_account_id AND p.sett_type = e.sett_type""")
def daily_fund_reconciliation(spark, sf):
    out = settlement.daily_fund_reconciliation(*_inputs(spark, sf))
    return out.withColumn("n_busi_date", D.day_key("n_busi_date"))


def _kept(cond: str, names: str, prefix: str = "") -> str:
    """Conditional sums of the columns, named ``new:expression``, ``new`` alone standing for itself."""
    pairs = [(x.split(":") * 2)[:2] for x in names.split()]
    return ", ".join(f"round(coalesce(sum(CASE WHEN {cond} THEN {e} END), 0), 2) AS {prefix}{n}" for n, e in pairs)


@query("monthly_fund_reconciliation", with_(*RECONCILED, s=SETT_DAY, t=TRADE_DAY, f=FEE_DAY, e=f"""
  SELECT d.busi_date AS n_date, d.month, d.busi_date = s.busi_date AS own, m.first_trade, m.last_trade, m.trade_days,
         m.natural_days, s.*, {ADDED}
  FROM s LEFT JOIN t ON s.busi_date = t.busi_date AND s.fund_account_id = t.fund_account_id
  LEFT JOIN f ON s.busi_date = f.busi_date AND s.fund_account_id = f.fund_account_id
  JOIN daymap d ON d.trade_date = s.busi_date JOIN months m ON m.month = d.month""", a=f"""
  SELECT month AS period, branch_id, client_id, fund_account_id, sett_type, money_type,
         {_kept("own AND busi_date = first_trade", """yes_rights begin_yes_impawn_money:yes_impawn_money fund_impawn_in_yes:lastfundmortgagein
                 fund_impawn_out_yes:lastfundmortgageout""")},
         {_kept("own AND busi_date = last_trade", "rights", "end_")},
         {_kept("own AND busi_date = last_trade", """fund_impawn_in fund_impawn_out open_pre_money impawn_money market_deposit buy_opt_market_value
                 sell_opt_market_value margin market_margin strike_credit credit""", "end_")},
         {_kept("own", """rt:rights open_pre_money impawn_money md:market_deposit jingshoufei:socrt_openfee jiesuanfei:settlementfee
                 fund_in:fund_in+strikeactreceivsum fund_out:fund_out+strikeactpaysum transfee:transfee+delivery_transfee+strikefee
                 market_transfee:market_transfee+market_delivery_transfee+market_strikefee trade_transfee:transfee
                 market_trade_transfee:market_transfee opt_premium_income opt_premium_pay today_profit hold_profit hold_profit_f close_profit
                 drop_profit_f fund_impawn_margin delivery_transfee market_delivery_transfee optstrike_profit strikefee market_strikefee
                 performfee market_performfee execute_transfee market_execute_transfee add_fee1 add_fee2 done_amount done_money done_amount_pj
                 done_money_pj clear_remain_transfee:net_fee""")},
         max(rights) AS max_rights, round(sum(rights), 2) AS rn, round(sum(open_pre_money), 2) AS total_open_pre_money,
         round(sum(impawn_money), 2) AS total_impawn_money, max(trade_days) AS trade_days, max(natural_days) AS natural_days
  FROM e GROUP BY month, branch_id, client_id, fund_account_id, sett_type, money_type""") + f"""
SELECT * EXCLUDE (rt, rn, md), rt / trade_days AS avg_trade_rights, rn / natural_days AS avg_nature_rights, md / trade_days AS avg_trade_market_deposit,
       round(transfee - market_transfee, 2) AS remain_transfee, round(trade_transfee - market_trade_transfee, 2) AS remain_trade_transfee,
       done_money * {LEVY} AS bzjj, CASE WHEN end_rights <> 0 THEN end_margin / end_rights ELSE 0 END AS risk_degree1,
       CASE WHEN end_rights <> 0 THEN end_market_margin / end_rights ELSE 0 END AS risk_degree2,
       round(end_impawn_money - begin_yes_impawn_money, 2) AS fund_impawn_chg, round(end_open_pre_money - end_impawn_money, 2) AS end_pre_impawn,
       round(end_buy_opt_market_value - end_sell_opt_market_value, 2) AS end_opt_market_value, round(open_pre_money - impawn_money, 2) AS pre_impawn,
       round(total_open_pre_money - total_impawn_money, 2) AS total_pre_impawn FROM a""")
def monthly_fund_reconciliation(spark, sf):
    return settlement.monthly_fund_reconciliation(*_inputs(spark, sf))


def _components(spark, sf):
    """The five component tables, from items booked to house accounts."""
    rows, zero = S.house_fills(spark, sf), F.lit(0.0)
    detail = rows.select("*", F.col("done_amt").alias("amount"), F.lit(10.0).alias("hand_amount"),
                         F.col("today_profit").alias("hold_profit_bydate"), F.col("today_profit").alias("hold_profit_bytrade"))
    part = lambda c, share: S.cents(F.col(c) * share)
    balance = rows.select("*", part("transfee", 0.5).alias("settfee"), part("margin", 0.01).alias("holdmovefee"), part("market_transfee", 0.5).alias("market_settfee"),
                          zero.alias("market_holdmovefee"), F.col("today_profit").alias("close_profit_bydate"),
                          F.col("today_profit").alias("close_profit_bytrade"), F.col("today_profit").alias("hold_profit_bytrade"),
                          F.col("margin").alias("market_value"), F.col("done_amt").alias("hold_amount"))
    done = rows.select("*", F.col("done_amt").alias("done_amount"), F.col("done_sum").alias("done_money"),
                       part("transfee", 0.2).alias("socrt_openfee"), part("transfee", 0.1).alias("settlementfee"), part("margin", 0.02).alias("add_fee1"),
                       part("margin", 0.03).alias("add_fee2"))
    delivery = rows.filter("trade_prop = '3'").select(
        "*", F.expr("CASE WHEN weekday(busi_date) < 4 THEN date_add(busi_date, 1) ELSE busi_date END AS sett_date"),
        F.expr("CASE WHEN month(busi_date) % 2 = 0 THEN 'CTP2' ELSE 'CTP1' END AS data_source"), F.col("done_amt").alias("pay_amount"))
    execute = rows.filter("trade_type IN ('12', '21') AND trade_order = '3'").select(
        "*", F.lit("0").alias("strike_type"), F.col("transfee").alias("strikefee"), F.col("market_transfee").alias("market_strikefee"),
        F.col("transfee").alias("execute_transfee"), F.col("market_transfee").alias("market_execute_transfee"),
        F.col("transfee").alias("performfee"), F.col("market_transfee").alias("market_performfee"),
        F.col("done_amt").alias("strike_qty"), F.col("sett_price").alias("strike_price"), F.lit(10.0).alias("hand_amount"),
        F.col("today_profit").alias("optstrike_profit"), F.col("margin").alias("strikefrozenmargin"),
        F.col("market_margin").alias("exchstrikefrozenmargin"))
    return detail, balance, done, delivery, execute


TRADE_KEYS = "period, client_id, branch_id, fund_account_id, money_type, trade_type, trade_prop, security_id"


# What a row of each component adds, by the name it is summed under (h open positions, f position fees, d fills, v deliveries, x exercise, e expiry).
_CENT = "floor({0} * {1}::DOUBLE * 100) / 100"
_FILL_FEE = f"transfee + {_CENT.format('transfee', 0.5)} + {_CENT.format('margin', 0.01)}"
_FILL_MARKET_FEE = f"market_transfee + {_CENT.format('market_transfee', 0.5)}"
_MONEY = "done_amt * sett_price * 10"


def _if(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} END"


def _sides(prefix: str, value: str, cond: str) -> dict[str, str]:
    return {f"{prefix}_{side}": _if(f"{cond} AND bs_direction = '{d}'", value) for side, d in (("buy", "0"), ("sell", "1"))}


ROW_SUMS = {
    "r": {**{f"h_{n}": _if("busi_date = last_trade", v) for n, v in (("amount", "done_amt"), ("money", _MONEY), ("profit", "today_profit"), ("margin", "margin"), ("mmargin", "market_margin"))},
          "h_all": "done_amt", **_sides("h_qq", _MONEY, "busi_date = last_trade AND trade_type = '12'"), **_sides("f_qq", "margin", "trade_type = '21'"),
          "f_fee": _FILL_FEE, "f_mfee": _FILL_MARKET_FEE, "f_profit": "today_profit", **{f"f_margin_{n}": _if(f"trade_prop = '{i}'", "margin") for n, i in (("tj", 1), ("tl", 2), ("tb", 3))},
          **_sides("f_hold", "done_amt", "TRUE"), "f_amt": "done_amt", "f_sum": "done_sum", "f_amt_pj": "close_amount_today", "f_sum_pj": "close_money_today",
          "d_open": _CENT.format("transfee", 0.2), "d_settle": _CENT.format("transfee", 0.1), "d_add1": _CENT.format("margin", 0.02), "d_add2": _CENT.format("margin", 0.03),
          "d_fee_pj": _if("trade_order = '3'", "transfee"), "d_mfee_pj": _if("trade_order = '3'", "market_transfee"), "d_rest_pj": _if("trade_order = '3'", "transfee - market_transfee"),
          **_sides("d_premium", "done_sum", "trade_type <> '11'"), "d_amt_qp": _if("force_flag = '1'", "done_amt"), "d_sum_qp": _if("force_flag = '1'", "done_sum"),
          "d_forced": _if("force_flag = '1'", "1")},
    "v": {"v_fee": "transfee", "v_mfee": "market_transfee", "v_rest": "transfee - market_transfee", "v_amt": "done_amt",
          "v_margin": _if("busi_date = last_trade", "margin"), "v_mmargin": _if("busi_date = last_trade", "market_margin"),
          **{f"v_margin_{n}": _if(f"busi_date = last_trade AND trade_prop = '{i}'", "margin") for n, i in (("tj", 1), ("tl", 2), ("tb", 3))}},
    "x": {"x_fee": "transfee", "x_mfee": "market_transfee", "x_rest": "transfee - market_transfee", **_sides("x_fee", "transfee", "TRUE"), **_sides("x_mfee", "market_transfee", "TRUE"),
          **_sides("x_qty", "done_amt", "TRUE"), "x_profit": "today_profit", "x_frozen": _if("trade_type = '21' AND book_day = last_trade", "margin"),
          "x_mfrozen": _if("trade_type = '21' AND book_day = last_trade", "market_margin"),
          **{n: _if("trade_type = '12' AND strftime(busi_date, '%Y%m%d') = contract_end", e) for n, e in (("e_qty", "done_amt"), ("e_money", _MONEY))}}}


def _exercised(shared: str, own: str) -> str:
    return f"CASE WHEN trade_type = '21' THEN round({shared}_buy + CASE WHEN market_id = 'CFFEX' THEN {shared}_sell ELSE 0 END, 2) ELSE {own} END"


def _performed(shared: str, own: str) -> str:
    return f"CASE WHEN trade_type = '21' THEN CASE WHEN market_id = 'CFFEX' THEN 0 ELSE {shared}_sell END ELSE {own} END"


def _trade_sql(grain: str) -> str:
    period = "strftime(busi_date, '%Y%m%d')" if grain == "day" else "strftime(busi_date, '%Y%m')"
    every = [n for sums in ROW_SUMS.values() for n in sums]
    union = " UNION ALL BY NAME ".join(
        f"SELECT {TRADE_KEYS}, {'days, busi_date AS d_day,' if frame == 'r' else ''} {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in sums.items())} FROM {frame}"
        for frame, sums in ROW_SUMS.items())
    by_kind = lambda side: f"CASE trade_type WHEN '21' THEN f_qq_{side} WHEN '12' THEN h_qq_{side} ELSE 0 END"
    return with_("house_fills", "daymap", "contract_months", "house_accounts", "levy", cal=f"""
  SELECT busi_date, {period} AS period, max(busi_date) OVER (PARTITION BY {period}) AS last_trade,
         CAST(count(*) OVER (PARTITION BY {period}) AS BIGINT) AS days FROM daymap WHERE trade_flag = 1""", nxt="""
  SELECT a.busi_date, min(b.busi_date) AS next_day FROM daymap a JOIN daymap b ON b.trade_flag = 1 AND b.busi_date > a.busi_date
  AND b.busi_date <= a.busi_date + 15 GROUP BY 1""", r="""
  SELECT * FROM house_fills JOIN cal USING (busi_date)""", settles="""
  SELECT *, CASE WHEN isodow(busi_date) < 5 THEN busi_date + 1 ELSE busi_date END AS sett_date FROM house_fills WHERE trade_prop = '3'""", dated=f"""
  SELECT *, CASE WHEN {period.replace('busi_date', 'sett_date')} IN (SELECT {period} FROM settles WHERE month(busi_date) % 2 = 0)
              THEN sett_date ELSE busi_date END AS dated_day FROM settles""", v="""
  SELECT dated.*, c.period, c.last_trade FROM dated JOIN cal c ON c.busi_date = dated_day""", x="""
  SELECT f.*, c.period, c.last_trade, n.next_day, s.delivery_date AS contract_end,
         CASE WHEN trade_type = '21' THEN next_day ELSE f.busi_date END AS book_day
  FROM house_fills f JOIN nxt n ON n.busi_date = f.busi_date JOIN securities s USING (security_id)
  JOIN cal c ON c.busi_date = CASE WHEN trade_type = '21' THEN next_day ELSE f.busi_date END
  WHERE trade_type IN ('12', '21') AND trade_order = '3'""", u=union, g=f"""
  SELECT {TRADE_KEYS}, max(days) AS own_days, CAST(count(DISTINCT d_day) AS DOUBLE) AS have_trade_num,
         {", ".join(f"round(coalesce(sum({n}), 0), 2) AS {n}" for n in every)} FROM u GROUP BY {TRADE_KEYS}""") + f"""
SELECT period, client_id, g.branch_id, g.fund_account_id, money_type, trade_type, trade_prop, g.security_id, market_id, product_id, deliv_date, a.client_type, a.open_date,
       h_amount AS hold_amount, h_money AS hold_money, h_profit AS hold_profit_bydate, h_profit AS hold_profit_bytrade,
       coalesce(round(h_all / own_days, 8), 0) AS hold_amount_avg, have_trade_num, {by_kind('buy')} AS buy_hold_money_qq, {by_kind('sell')} AS sell_hold_money_qq,
       round(h_margin + v_margin, 2) AS margin, round(h_mmargin + v_mmargin, 2) AS market_margin,
       {", ".join(f"round(f_margin_{n} + v_margin_{n}, 2) AS margin_{n}" for n in ("tj", "tl", "tb"))},
       d_fee_pj AS transfee_pj, d_mfee_pj AS market_transfee_pj, d_rest_pj AS remain_transfee_pj, d_premium_sell AS opt_premium_income,
       d_premium_buy AS opt_premium_pay, d_add1 AS add_fee1, d_add2 AS add_fee2, d_amt_qp AS done_amount_qp, d_sum_qp AS done_money_qp, d_forced AS force_number,
       d_open AS jingshoufei, d_settle AS jiesuanfei, round(d_premium_sell - d_premium_buy, 2) AS opt_premium_income_pay,
       f_amt AS done_amount, f_amt_pj AS done_amount_pj, f_sum AS done_money, f_sum_pj AS done_money_pj, f_profit AS close_profit_bydate, f_profit AS close_profit_bytrade,
       f_hold_buy AS hold_amount_buy, f_hold_sell AS hold_amount_sell, f_profit AS total_profit, round(f_profit + f_profit, 2) AS float_profit,
       v_fee AS deliv_transfee, v_mfee AS deliv_market_transfee, v_rest AS deliv_remain_transfee, v_margin AS deliv_margin, v_mmargin AS deliv_market_margin,
       v_amt AS delivery_amount, v_amt AS done_amt,
       {_exercised('x_fee', 'x_fee')} AS transfee_xq, {_exercised('x_mfee', 'x_mfee')} AS market_transfee_xq, {_performed('x_fee', 'x_fee')} AS transfee_ly,
       {_performed('x_mfee', 'x_mfee')} AS market_transfee_ly, {_exercised('x_qty', 'x_qty_buy')} AS strike_qty_xq, {_performed('x_qty', 'x_qty_sell')} AS strike_qty_ly,
       e_qty AS strike_qty_dq, e_money AS strike_money_dq, x_profit AS optstrike_profit, x_frozen AS strikefrozenmargin, x_mfrozen AS exchstrikefrozenmargin,
       round({_exercised('x_fee', 'x_fee')} - {_exercised('x_mfee', 'x_mfee')}, 2) AS remain_transfee_xq, f_fee AS trade_transfee, f_mfee AS market_trade_transfee,
       round(f_fee - f_mfee, 2) AS trade_remain_transfee, round(f_fee + v_fee + x_fee, 2) AS total_transfee, round(f_mfee + v_mfee + x_mfee, 2) AS total_market_transfee,
       round(f_fee - f_mfee + v_rest + x_rest, 2) AS total_remain_transfee, f_sum * {LEVY} AS bzjj, round(f_profit - round(f_fee + v_fee + x_fee, 2), 2) AS clear_profit
FROM g JOIN contract_months c ON c.security_id = g.security_id LEFT JOIN house_accounts a ON a.fund_account_id = g.fund_account_id"""


def _trade_statistics(grain):
    def run(spark, sf):
        return trades.trade_statistics(*_components(spark, sf), S.securities(spark, sf), S.house_accounts(spark, sf),
                                       S.calendar(spark, sf), grain, settlement.levy_rate(S.fees(spark, sf)))
    return run


query("daily_trade_statistics", _trade_sql("day"))(_trade_statistics("day"))
query("monthly_trade_statistics", _trade_sql("month"))(_trade_statistics("month"))
