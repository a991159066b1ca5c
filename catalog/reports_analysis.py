"""Operating and client analysis at the three organisation levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import reports_income as I, reports_ledger as L, reports_targets as T, standins as S
from catalog.operator_queries import BIRTH_SQL
from catalog.registry import QUERIES, SQL, query
from catalog.standins import cents, cte, table, with_
from marginbook.functions import dates as D
from marginbook.functions import measures as M
from marginbook.operators.joins import scaffold
from marginbook.plans import analysis as A, income
from marginbook.sources.scratch import stored

LEVELS = ("unit", "line", "respons")


def org(spark, sf, level="unit"):
    return A.Organisation(S.accounts(spark, sf), S.branch_map(spark, sf), S.units(spark, sf), level)


def levels(name: str, sql, fn) -> None:
    """Register one query per organisation level; ``sql`` and ``fn`` take the level."""
    for level in LEVELS:
        query(f"{name}_by_{level}", sql(level))(lambda spark, sf, level=level: fn(spark, sf, org(spark, sf, level)))


def spots(spark, sf, level="unit"):
    key = {"unit": "departmentid", "line": "business_line_id", "respons": "respons_line_id"}[level]
    orgs = S.units(spark, sf).select(F.col(key).alias("org_id")).filter("org_id IS NOT NULL").distinct()
    return scaffold(orgs, S.calendar(spark, sf).select(D.month_key("busi_date").alias("period")).distinct())


def yoy(now: str, last: str) -> str:
    return f"CASE WHEN {last} <> 0 THEN ({now} / {last} - 1) * 100 ELSE 0 END"


def ratio(n: str, d: str, scale: str = "") -> str:
    return f"CASE WHEN {d} <> 0 THEN coalesce({n}, 0) / {d}{scale} ELSE 0 END"


BACK = "strftime(strptime({} || '01', '%Y%m%d') - INTERVAL 1 YEAR, '%Y%m')"


def back(c: str) -> str:
    return BACK.format(c)


# ---- daily ----------------------------------------------------------------------------------------

levels("daily_operating_analysis", lambda lv: with_("client_sett", "accounts", f"org_{lv}", "daymap", d=f"""
  SELECT org_id, busi_date, round(sum(rights), 2) AS total,
         round(coalesce(sum(CASE WHEN open_date BETWEEN date_trunc('year', busi_date) AND busi_date THEN rights END), 0), 2) AS fresh,
         round(coalesce(sum(CASE WHEN NOT (open_date BETWEEN date_trunc('year', busi_date) AND busi_date) THEN rights END), 0), 2) AS stock
  FROM client_sett s JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""") + f"""
SELECT strftime(d.busi_date, '%Y%m%d') AS busi_date, d.org_id, stock / 10000 AS stock_end_rights, {ratio('stock', 'd.total', ' * 100')} AS stock_end_rights_prop,
       fresh / 10000 AS new_end_rights, {ratio('fresh', 'd.total', ' * 100')} AS new_end_rights_prop, d.total / 10000 AS end_rights,
       {yoy('d.total', 'b.total')} AS end_rights_yoy
FROM d LEFT JOIN daymap m ON m.busi_date = CAST(d.busi_date - INTERVAL 1 YEAR AS DATE)
LEFT JOIN (SELECT org_id, busi_date, total FROM d) b ON b.org_id = d.org_id AND b.busi_date = m.trade_date""",
       lambda spark, sf, o: A.daily_operating_analysis(S.client_sett(spark, sf), o, S.calendar(spark, sf)).withColumn("busi_date", D.day_key("busi_date")))

# ---- rankings -------------------------------------------------------------------------------------


def _top_sql(lv: str) -> str:
    period = "CAST(isoyear(busi_date) * 100 + week(busi_date) AS VARCHAR)"
    join = f"JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id"
    metrics = [("f", "1", "fund_in", "DESC"), ("f", "2", "fund_out", "DESC"), ("f", "3", "profit", "DESC"), ("f", "4", "profit", "ASC"),
               ("f", "5", "fee", "DESC"), ("t", "6", "amt", "DESC"), ("t", "7", "money", "DESC")]
    parts = " UNION ALL ".join(
        f"SELECT period, org_id, fund_account_id, client_name, '{c}' AS index_type, {m} AS value, rank() OVER (PARTITION BY period, org_id ORDER BY {m} {o}) AS r FROM {t}"
        for t, c, m, o in metrics)
    return with_("client_sett", "fills", "accounts", f"org_{lv}", f=f"""
  SELECT {period} AS period, org_id, s.fund_account_id, client_name, round(sum(fund_in), 2) AS fund_in, round(sum(fund_out), 2) AS fund_out,
         round(sum(today_profit), 2) AS profit, round(sum({I.RETAINED_SQL}), 2) AS fee FROM client_sett s {join} GROUP BY 1, 2, 3, 4""", t=f"""
  SELECT {period} AS period, org_id, s.fund_account_id, client_name, round(sum(done_amt), 2) AS amt, round(sum(done_sum), 2) AS money
  FROM fills s {join} GROUP BY 1, 2, 3, 4""") + f"""
SELECT period, org_id, fund_account_id, client_name, index_type, value, CAST(r AS INTEGER) AS rank_no FROM ({parts}) WHERE r <= 9"""


levels("top_clients", _top_sql, lambda spark, sf, o: A.top_clients(S.client_sett(spark, sf), S.fills(spark, sf), o))

levels("product_ranking", lambda lv: with_("fills", "securities", "accounts", f"org_{lv}", p=f"""
  SELECT strftime(busi_date, '%Y%m') AS period, org_id, product_id, round(sum(done_amt), 2) AS amt, round(sum(done_sum), 2) AS money
  FROM fills s JOIN securities USING (security_id) JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2, 3""") + """
SELECT period, org_id, product_id, amt / 10000 AS done_amount, money / 100000000 AS done_money,
       CAST(rank() OVER (PARTITION BY period, org_id ORDER BY amt DESC) AS INTEGER) AS rank_done_amount,
       CAST(rank() OVER (PARTITION BY period, org_id ORDER BY money DESC) AS INTEGER) AS rank_done_money FROM p""",
       lambda spark, sf, o: A.product_ranking(S.fills(spark, sf), S.securities(spark, sf), o))

# ---- monthly families ---------------------------------------------------------------------------------

NEW = "substr({p}, 1, 4) = strftime(open_date, '%Y') AND strftime(open_date, '%Y%m') <= {p}"


def deductions(spark, sf):
    """Own-fund equity taken off a unit's average: from its suppliers' balances."""
    return (table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(D.month_key("l_shipdate").alias("period"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("oa_branch_id"))
            .agg(M.money_sum(cents(F.col("l_extendedprice") * 0.01)).alias("deduction")))


cte("deductions", """
SELECT strftime(l_shipdate, '%Y%m') AS period, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS oa_branch_id,
       round(sum(floor(l_extendedprice * 0.01::DOUBLE * 100) / 100), 2) AS deduction
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
for _lv, _key in (("unit", "departmentid"), ("line", "business_line_id"), ("respons", "respons_line_id")):
    cte(f"of_{_lv}", f"SELECT departmentid AS oa_branch_id, {_key} AS org_id FROM units WHERE {_key} IS NOT NULL", "units")


def _since_january(lv: str, fact: str, measures: dict[str, str]) -> dict[str, str]:
    """Sums since January by the rule itself: every month looks at all rows of its year so far."""
    new = NEW.format(p="k.period")
    cols = ", ".join(f"round(sum({m}), 2) AS {n}" for n, m in measures.items())
    ytd = ", ".join(f"round(sum(r.{n}), 2) AS y_{n}, round(coalesce(sum(CASE WHEN {new} THEN r.{n} END), 0), 2) AS y_{n}_new" for n in measures)
    return dict(r=f"""
  SELECT org_id, month AS period, open_date, {cols} FROM {fact} s JOIN tradedays t USING (busi_date)
  JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2, 3""", y=f"""
  SELECT k.org_id, k.period, {ytd} FROM (SELECT DISTINCT org_id, period FROM r) k
  JOIN r ON r.org_id = k.org_id AND substr(r.period, 1, 4) = substr(k.period, 1, 4) AND r.period <= k.period GROUP BY 1, 2""", yd="""
  SELECT k.month AS period, sum(d.trade_days) AS y_days FROM (SELECT DISTINCT month FROM tradedays) k
  JOIN (SELECT DISTINCT month, trade_days FROM tradedays) d ON substr(d.month, 1, 4) = substr(k.month, 1, 4) AND d.month <= k.month GROUP BY 1""")


def _equity_sql(lv: str) -> str:
    return with_("client_sett", "tradedays", "accounts", f"org_{lv}", "deductions", f"of_{lv}", **_since_january(lv, "client_sett", {"rights": "rights"}), e=f"""
  SELECT org_id, month AS period, round(sum(rights), 2) AS rights, max(trade_days) AS days
  FROM client_sett s JOIN tradedays t USING (busi_date) JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", c=f"""
  SELECT org_id, period, round(sum(deduction), 2) AS cut FROM deductions JOIN of_{lv} USING (oa_branch_id) GROUP BY 1, 2""", m="""
  SELECT e.*, rights / days AS avg, rights / days - coalesce(cut, 0) AS assess FROM e LEFT JOIN c ON c.org_id = e.org_id AND c.period = e.period""") + f"""
SELECT m.org_id, m.period, m.avg / 10000 AS avg_rights, {yoy('m.avg', 'l.avg')} AS avg_rights_yoy, m.assess / 10000 AS assess_avg_rights,
       {yoy('m.assess', 'l.assess')} AS assess_avg_rights_yoy, (y_rights - y_rights_new) / y_days / 10000 AS avg_rights_stock,
       {ratio('(y_rights - y_rights_new)', 'y_rights', ' * 100')} AS avg_rights_stock_prop,
       y_rights_new / y_days / 10000 AS avg_rights_new, {ratio('y_rights_new', 'y_rights', ' * 100')} AS avg_rights_new_prop
FROM m JOIN y ON y.org_id = m.org_id AND y.period = m.period JOIN yd ON yd.period = m.period
LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}"""


def equity(spark, sf, o):
    return A.equity_analysis(S.client_sett(spark, sf), o, S.calendar(spark, sf), deductions(spark, sf))


levels("equity_analysis", _equity_sql, equity)


def _turnover_sql(lv: str) -> str:
    share = {"stock": "(y.y_{0} - y.y_{0}_new)", "new": "y.y_{0}_new"}
    cols = ", ".join(f"{e.format('amt')} / 10000 AS done_amount_{p}, {ratio(e.format('amt'), 'y.y_amt', ' * 100')} AS done_amount_{p}_prop, "
                     f"{e.format('money')} / 10000 AS done_money_{p}, {ratio(e.format('money'), 'y.y_money', ' * 100')} AS done_money_{p}_prop" for p, e in share.items())
    return with_("fills", "tradedays", "accounts", f"org_{lv}", **_since_january(lv, "fills", {"amt": "done_amt", "money": "done_sum"}), m="""
  SELECT org_id, period, round(sum(amt), 2) AS amt, round(sum(money), 2) AS money FROM r GROUP BY 1, 2""") + f"""
SELECT m.org_id, m.period, m.amt / 10000 AS done_amount, {yoy('m.amt', 'l.amt')} AS done_amount_yoy, m.money / 100000000 AS done_money,
       {yoy('m.money', 'l.money')} AS done_money_yoy, {cols} FROM m JOIN y ON y.org_id = m.org_id AND y.period = m.period
LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}"""


levels("turnover_analysis", _turnover_sql, lambda spark, sf, o: A.turnover_analysis(S.fills(spark, sf), o, S.calendar(spark, sf)))

levels("client_counts", lambda lv: with_("fills", "accounts", f"org_{lv}", "months", own=f"SELECT a.*, org_id FROM accounts a JOIN org_{lv} o ON o.branch_id = a.branch_id", m="""
  SELECT o.org_id, k.month AS period, (SELECT count(*) FROM own w WHERE w.org_id = o.org_id AND strftime(open_date, '%Y%m') <= k.month) AS total,
         (SELECT count(*) FROM own w WHERE w.org_id = o.org_id AND strftime(open_date, '%Y%m') = k.month) AS opened, coalesce(t.n, 0) AS active
  FROM (SELECT DISTINCT org_id FROM own) o CROSS JOIN months k LEFT JOIN (
    SELECT org_id, q.month, count(DISTINCT fund_account_id) AS n FROM months q JOIN (
      SELECT DISTINCT org_id, fund_account_id, strftime(busi_date, '%Y%m') AS done FROM fills JOIN own USING (fund_account_id)) f
      ON substr(f.done, 1, 4) = substr(q.month, 1, 4) AND f.done <= q.month GROUP BY 1, 2) t
    ON t.org_id = o.org_id AND t.month = k.month""") + f"""
SELECT m.org_id, m.period, m.total AS total_client_num, {yoy('m.total', 'l.total')} AS total_client_num_yoy, m.opened AS new_client_num,
       {yoy('m.opened', 'l.opened')} AS new_client_num_yoy, m.active AS total_active_num, {yoy('m.active', 'l.active')} AS total_active_num_yoy
FROM m LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}""",
       lambda spark, sf, o: A.client_counts(S.fills(spark, sf), o, S.calendar(spark, sf)))


def _mix(lv: str) -> dict[str, str]:
    new = NEW.format(p="busi_month")
    cols = ", ".join(f"round(sum({c}), 4) AS {c}, round(coalesce(sum(CASE WHEN {new} THEN {c} END), 0), 4) AS {c}_new, "
                     f"round(coalesce(sum(CASE WHEN NOT ({new}) THEN {c} END), 0), 4) AS {c}_stock" for c in A.INCOME_PARTS)
    names = [f"{c}{s}" for c in A.INCOME_PARTS for s in ("", "_new", "_stock")] + ["feature_income_total"]
    year = ", ".join(f"round(sum({n}) OVER w, 4) AS {n}" for n in names)
    pos = lambda n, d: f"CASE WHEN {d} > 0 THEN {n} / {d} * 100 ELSE 0 END"
    out = ", ".join(f"{c} / 10000 AS {c}_income, {pos(c, 'feature_income_total')} AS {c}_prop, {pos(f'{c}_stock', c)} AS {c}_stock_prop, "
                    f"{pos(f'{c}_new', c)} AS {c}_new_prop" for c in A.INCOME_PARTS)
    return dict(bm=f"""
  SELECT org_id, busi_month AS period, {cols}, round(sum(feature_income_total), 4) AS feature_income_total
  FROM brokerage b JOIN accounts a ON a.fund_account_id = b.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", ytd=f"""
  SELECT org_id, period, {year} FROM bm WINDOW w AS (PARTITION BY org_id, substr(period, 1, 4) ORDER BY period)""", mix=f"""
  SELECT org_id, period, feature_income_total / 10000 AS future_income, {out} FROM ytd""")


def income_mix(spark, sf, o):
    return A.income_mix(I.brokerage_rows(spark, sf), o)


levels("income_mix", lambda lv: with_(*I.BROKERAGE_NEEDS, f"org_{lv}", **I.BROKERAGE_PARTS, **_mix(lv)) + "SELECT * FROM mix", income_mix)

levels("finance_analysis", lambda lv: with_("statement", "books", f"of_{lv}", m=f"""
  SELECT org_id, month_id AS period, round(sum(f5), 2) AS income, round(sum(f21), 2) AS profit FROM statement JOIN books USING (book_id) JOIN of_{lv} USING (oa_branch_id) GROUP BY 1, 2""") + f"""
SELECT m.org_id, m.period, m.income / 10000 AS assess_income, {yoy('m.income', 'l.income')} AS assess_income_yoy, m.profit / 10000 AS assess_profit,
       {yoy('m.profit', 'l.profit')} AS assess_profit_yoy FROM m LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}""",
       lambda spark, sf, o: A.finance_analysis(L.statement(spark, sf), S.books(spark, sf), o))

levels("market_share", lambda lv: with_("client_sett", "fills", "tradedays", "accounts", f"org_{lv}", "industry", e=f"""
  SELECT org_id, month AS period, round(sum(rights), 2) AS rights, round(sum(transfee + delivery_transfee + strikefee), 2) AS fee, max(trade_days) AS days
  FROM client_sett s JOIN tradedays t USING (busi_date) JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", d=f"""
  SELECT org_id, month AS period, round(sum(done_amt), 2) AS amt, round(sum(done_sum), 2) AS money
  FROM fills s JOIN tradedays t USING (busi_date) JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", i="""
  SELECT busi_month AS period, round(fee, 6) * 100000000 AS fee, round(rights, 6) * 100000000 AS rights, round(turnover, 6) * 2 * 100000000 AS turnover, round(volume, 6) * 2 AS volume FROM industry""") + """
SELECT e.org_id, e.period, CASE WHEN coalesce(i.rights, 0) / days <> 0 THEN (e.rights / days) / (i.rights / days) ELSE 0 END * 10000 AS avg_rights_market_rate,
       CASE WHEN i.fee <> 0 THEN e.fee / i.fee ELSE 0 END * 10000 AS futu_trans_income_market_rate,
       CASE WHEN turnover <> 0 THEN coalesce(money, 0) / turnover ELSE 0 END * 10000 AS done_money_market_rate,
       CASE WHEN volume <> 0 THEN coalesce(amt, 0) / volume ELSE 0 END * 10000 AS done_amount_market_rate
FROM e LEFT JOIN d ON d.org_id = e.org_id AND d.period = e.period LEFT JOIN i ON i.period = e.period""",
       lambda spark, sf, o: A.market_share(S.client_sett(spark, sf), S.fills(spark, sf), T.industry(spark, sf), o, S.calendar(spark, sf)))


# ---- side business ---------------------------------------------------------------------------------

def side_frames(spark, sf):
    """Unit-level side-business rows seen in orders, per month and nation; an order's status is its trade type, its priority the type
    of a share in advice."""
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("oa_branch_id"))
    p, keys = F.col("o_totalprice"), ["period", "oa_branch_id"]
    o = table(spark, sf, "orders").join(cust, "o_custkey").withColumn("period", D.month_key("o_orderdate"))
    trade = F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise("2")
    share = F.when(F.col("o_orderpriority") == "1-URGENT", "0").when(F.col("o_orderpriority") == "2-HIGH", "1").otherwise("2")
    sales = o.select(*keys, trade.alias("wh_trade_type"), p.alias("confirm_share"))
    advisory = o.select(*keys, share.alias("alloca_oa_branch_type"), p.alias("invest_total_service_fee"),
                        F.lit(0.5).alias("kernel_total_rate"), F.lit(0.25).alias("alloca_kernel_rate"))
    options = o.select(*keys, p.alias("notional_principal"), cents(p * 0.1).alias("total_absolute_royalty"),
                       cents(p * 0.02).alias("collaborative_income"), cents(p * 0.04).alias("total_income"))
    tracking = o.select(*keys, F.concat(F.lit("J"), (F.col("o_custkey") % 50).cast("string")).alias("project_name"),
                        p.alias("ending_interest"), cents(p * 0.03).alias("synergistic_revenue"))
    discounts = o.select(*keys, cents(p * 0.05).alias("depart_real_allocation_right"))
    return sales, advisory, options, tracking, discounts


cte("side", """
SELECT strftime(o_orderdate, '%Y%m') AS period, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS oa_branch_id,
       CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '2' END AS trade,
       CASE o_orderpriority WHEN '1-URGENT' THEN '0' WHEN '2-HIGH' THEN '1' ELSE '2' END AS share,
       o_custkey, o_totalprice AS p, floor(o_totalprice * 0.1::DOUBLE * 100) / 100 AS p10,
       floor(o_totalprice * 0.02::DOUBLE * 100) / 100 AS p2, floor(o_totalprice * 0.03::DOUBLE * 100) / 100 AS p3,
       floor(o_totalprice * 0.04::DOUBLE * 100) / 100 AS p4, floor(o_totalprice * 0.05::DOUBLE * 100) / 100 AS p5 FROM orders JOIN customer ON o_custkey = c_custkey""")


def brokers(spark, sf):
    """Introducing-broker equity and income with units, from the cooperation reports."""
    unit = S.branch_map(spark, sf).filter("oa_branch_id IS NOT NULL").select(F.col("ctp_branch_id").alias("branch_id"), "oa_branch_id")
    coop = I.cooperation_summary(spark, sf).join(unit, "branch_id").select(F.col("month_id").alias("period"), "oa_branch_id", "end_rights", "avg_rights")
    staff = I.staff_rows(spark, sf).select(F.col("month_id").alias("period"), "oa_branch_id", "end_rights", "avg_rights")
    return coop, staff, unit


def side_rows(spark, sf, o, level="unit"):
    sales, advisory, options, tracking, discounts = side_frames(spark, sf)
    coop, staff, unit = brokers(spark, sf)
    ci = I.cooperation_income(spark, sf).join(unit, "branch_id").select(F.col("month_id").alias("period"), "oa_branch_id", "xt_income")
    ri = I.resident_income(spark, sf).join(unit, "branch_id").select(F.col("month_id").alias("period"), "oa_branch_id", "zd_income")
    return A.side_business(o, spots(spark, sf, level), sales, advisory, options, coop, staff, ci, ri, tracking, discounts)


SIDE_FEE = "p * 0.5::DOUBLE * 0.25::DOUBLE"
def _side_parts(lv: str) -> dict[str, str]:
    """Written from the rule: each month of each organisation looks at all rows from 1 January (or ever) to its end."""
    ever = ("held",)
    year = ("bought", "adv", "advx", "principal", "royalty", "otc", "own", "own_end", "discount")
    cents_ = ("held", "own_end", "discount")
    sums = ", ".join([f"round(coalesce(sum(m.{c}), 0), {2 if c in cents_ else 6}) AS {c}" for c in ever]
                     + [f"round(coalesce(sum(CASE WHEN substr(m.period, 1, 4) = substr(sp.period, 1, 4) THEN m.{c} END), 0), {2 if c in cents_ else 6}) AS {c}" for c in year])
    return dict(sp=f"SELECT DISTINCT org_id, month AS period FROM of_{lv} CROSS JOIN months", so=f"""
  SELECT org_id, side.* FROM side JOIN of_{lv} USING (oa_branch_id)""", sm=f"""
  SELECT org_id, period, round(sum(p), 2) AS held, round(sum(CASE WHEN trade IN ('0', '1') THEN p END), 6) AS bought,
         round(sum(CASE WHEN share IN ('0', '1') THEN {SIDE_FEE} END), 6) AS adv, round(sum(CASE WHEN share = '1' THEN {SIDE_FEE} END), 6) AS advx,
         round(sum(p), 6) AS principal, round(sum(p10), 6) AS royalty, round(sum(p2), 6) AS otc, round(sum(p3), 6) AS own, round(sum(p), 2) AS own_end,
         round(sum(p5), 2) AS discount FROM so GROUP BY 1, 2""", sv=f"""
  SELECT sp.org_id, sp.period, {sums} FROM sp LEFT JOIN sm m ON m.org_id = sp.org_id AND m.period <= sp.period GROUP BY 1, 2""", sn="""
  SELECT sp.org_id, sp.period, CAST(count(DISTINCT s.o_custkey % 50) AS DOUBLE) AS nums FROM sp
  JOIN so s ON s.org_id = sp.org_id AND substr(s.period, 1, 4) = substr(sp.period, 1, 4) AND s.period <= sp.period GROUP BY 1, 2""")


SIDE_AMOUNTS = {"held": "product_sales_stock", "bought": "product_sales_new", "adv": "trade_zx_income", "advx": "trade_zx_xc_income", "principal": "off_site_princi",
                "royalty": "off_site_option", "otc": "off_site_income", "own": "own_funds_income", "own_end": "own_funds_end_rights", "discount": "own_funds_discounts"}


def _side_sql(lv: str) -> str:
    broker = f"JOIN org_{lv} o ON o.branch_id = c.branch_id"
    return with_("side", "units", "months", "client_sett", "tradedays", "agreements", "branch_map", f"of_{lv}", f"org_{lv}", *I.STAFF_NEEDS,
                 **_side_parts(lv), **I.COOP_SUMMARY, **I.STAFF, ci=SQL["cooperation_income"], ri=SQL["resident_income"], ib=f"""
  SELECT org_id, period, sum(v) AS v FROM (
    SELECT org_id, month_id AS period, round(sum(avg_rights), 6) AS v FROM staff JOIN of_{lv} USING (oa_branch_id) GROUP BY 1, 2
    UNION ALL SELECT o.org_id, month_id, round(sum(avg_rights), 6) FROM coop c {broker} GROUP BY 1, 2) GROUP BY 1, 2""", ii=f"""
  SELECT org_id, period, sum(v) AS v FROM (
    SELECT o.org_id, month_id AS period, round(sum(xt_income), 6) AS v FROM ci c {broker} GROUP BY 1, 2
    UNION ALL SELECT o.org_id, month_id, round(sum(zd_income), 6) FROM ri c {broker} GROUP BY 1, 2) GROUP BY 1, 2""") + """
SELECT sp.org_id, sp.period, """ + ", ".join(f"sv.{c} / 10000 AS xt_{n}" for c, n in SIDE_AMOUNTS.items()) + """,
       coalesce(nums, 0) AS xt_own_funds_nums, coalesce(ib.v, 0) / 10000 AS xt_colla_avg_rights, coalesce(ii.v, 0) / 1.06::DOUBLE / 10000 AS xt_colla_income
FROM sp LEFT JOIN sv ON sv.org_id = sp.org_id AND sv.period = sp.period LEFT JOIN sn ON sn.org_id = sp.org_id AND sn.period = sp.period
LEFT JOIN ib ON ib.org_id = sp.org_id AND ib.period = sp.period LEFT JOIN ii ON ii.org_id = sp.org_id AND ii.period = sp.period"""


def revenue_rows(spark, sf, o, mix=None, side=None):
    """``mix`` and ``side`` are the income mix and the side business, where they are at hand already."""
    products = None
    for fof in (True, False):
        part = income.product_income(I.values(spark, sf), I.product_accounts(spark, sf), I.products(spark, sf), I.parameters(spark, sf), S.calendar(spark, sf), fof).select(
            "busi_month", "filing_code", "total_futu_income")
        products = part if products is None else products.unionByName(part)
    ours = (products.join(I.allocation(spark, sf), "filing_code")
            .select(F.col("busi_month").alias("period"), F.col("alloca_oa_branch_id").alias("oa_branch_id"), (F.col("total_futu_income") * F.col("alloca_rate") / A.WAN).alias("v")))
    where = spots(spark, sf, o.level)
    sold = A.year_to_date(ours, F.col("v"), "product_sell_income", o, where, 8)
    options = A.year_to_date(side_frames(spark, sf)[2], F.col("total_income"), "v", o, where).select("org_id", "period", (F.col("v") / A.WAN).alias("option_income"))
    mix = income_mix(spark, sf, o) if mix is None else mix
    return A.revenue_mix(mix, side_rows(spark, sf, o, o.level) if side is None else side, sold, options)


def _revenue_sql(lv: str, side: str, mix: str) -> str:
    parts = {"future_income": "fi", "trade_zx_income": "zx", "product_xc_income": "pr", "over_option_income": "ov", "own_funds_income": "ow"}
    total = "(" + " + ".join(parts.values()) + ")"
    so_far = lambda frame, scale: f"""
  SELECT sb.org_id, sb.period, round(coalesce(sum(m.v), 0), {scale}) AS v FROM sb LEFT JOIN {frame} m
  ON m.org_id = sb.org_id AND substr(m.period, 1, 4) = substr(sb.period, 1, 4) AND m.period <= sb.period GROUP BY 1, 2"""  # noqa: E731
    return with_("side", "allocation", f"of_{lv}", sb=SQL[side], mx=SQL[mix], ff=SQL["fund_of_funds_income"], op=SQL["ordinary_product_income"], pm=f"""
  SELECT org_id, busi_month AS period, round(sum(total_futu_income * alloca_rate / 10000), 8) AS v
  FROM (SELECT busi_month, filing_code, total_futu_income FROM ff UNION ALL SELECT busi_month, filing_code, total_futu_income FROM op)
  JOIN allocation USING (filing_code) JOIN of_{lv} ON oa_branch_id = alloca_oa_branch_id GROUP BY 1, 2""", py=so_far("pm", 8), om=f"""
  SELECT org_id, period, round(sum(p4), 6) AS v FROM side JOIN of_{lv} USING (oa_branch_id) GROUP BY 1, 2""", oy=so_far("om", 6), j="""
  SELECT sb.org_id, sb.period, coalesce(mx.future_income, 0) AS fi, xt_trade_zx_income AS zx, py.v AS pr, oy.v / 10000 AS ov, xt_own_funds_income AS ow
  FROM sb LEFT JOIN mx ON mx.org_id = sb.org_id AND mx.period = sb.period JOIN py ON py.org_id = sb.org_id AND py.period = sb.period
  JOIN oy ON oy.org_id = sb.org_id AND oy.period = sb.period""") + f"""
SELECT org_id, period, {total} AS operat_income, """ + ", ".join(f"CASE WHEN {total} <> 0 THEN {e} / {total} * 100 ELSE 0 END AS {n}_prop" for n, e in parts.items()) + " FROM j"


FAMILIES = ("equity_analysis", "turnover_analysis", "finance_analysis", "client_counts", "income_mix", "market_share")


def _monthly(spark, sf, o):
    # Both have one row per organisation and month, come from many scans, and are columns here and input of the revenue mix.
    mix, side = stored(income_mix(spark, sf, o)), stored(side_rows(spark, sf, o, o.level))
    parts = [mix if n == "income_mix" else QUERIES[f"{n}_by_{o.level}"](spark, sf) for n in FAMILIES]
    return A.monthly_operating_analysis(spots(spark, sf, o.level), [*parts, side, revenue_rows(spark, sf, o, mix, side)])


def _monthly_sql(lv: str, side: str, revenue: str) -> str:
    names = {f"f{i}": SQL[n] for i, n in enumerate([*(f"{n}_by_{lv}" for n in FAMILIES), side, revenue])}
    joins = " ".join(f"LEFT JOIN {f} ON {f}.org_id = b.org_id AND {f}.period = b.period" for f in names)
    return with_("months", f"of_{lv}", b=f"SELECT DISTINCT org_id, month AS period FROM of_{lv} CROSS JOIN months", **names) + f"""
SELECT b.*, {', '.join(f'{f}.* EXCLUDE (org_id, period)' for f in names)} FROM b {joins}"""


for _lv in LEVELS:
    _side, _rev = ("side_business", "revenue_mix") if _lv == "unit" else (f"side_business_by_{_lv}", f"revenue_mix_by_{_lv}")
    query(_side, _side_sql(_lv))(lambda spark, sf, lv=_lv: side_rows(spark, sf, org(spark, sf, lv), lv))
    query(_rev, _revenue_sql(_lv, _side, f"income_mix_by_{_lv}"))(lambda spark, sf, lv=_lv: revenue_rows(spark, sf, org(spark, sf, lv)))
    query(f"monthly_operating_analysis_by_{_lv}", _monthly_sql(_lv, _side, _rev))(lambda spark, sf, lv=_lv: _monthly(spark, sf, org(spark, sf, lv)))


# ---- clients ------------------------------------------------------------------------------------------

KINDS = {"0": "client_type = '0'", "1": "client_type = '1'", "3": "client_type IN ('3', '4')"}


def _kind_sums(v: str) -> str:
    return ", ".join(f"round(coalesce(sum(CASE WHEN {c} THEN {v} END), 0), 4) AS s{t}" for t, c in KINDS.items())


def _mix_sql(lv: str, source: str, v: str, prefix: str) -> str:
    cols = ", ".join(f"m.x{t} AS {prefix}_{t}, {yoy(f'm.x{t}', f'l.x{t}')} AS {prefix}_{t}_yoy" for t in KINDS)
    share = ", ".join(f"{ratio(f's{t}', 'total', ' * 100')} AS x{t}" for t in KINDS)
    return with_(source, "tradedays", "accounts", f"org_{lv}", g=f"""
  SELECT org_id, month AS period, round(sum({v}), 4) AS total, {_kind_sums(v)} FROM {source} s JOIN tradedays t USING (busi_date)
  JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", m=f"SELECT org_id, period, {share} FROM g") + f"""
SELECT m.org_id, m.period, {cols} FROM m LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}"""


levels("client_equity_mix", lambda lv: _mix_sql(lv, "client_sett", "rights", "rights"),
       lambda spark, sf, o: A.client_type_mix(A.per_account(S.client_sett(spark, sf), ["rights"], S.calendar(spark, sf)), o, "rights", "rights"))
levels("client_turnover_mix", lambda lv: _mix_sql(lv, "fills", "done_sum", "done_money"),
       lambda spark, sf, o: A.client_type_mix(A.per_account(S.fills(spark, sf), ["done_sum"], S.calendar(spark, sf)), o, "done_sum", "done_money"))
levels("client_volume_mix", lambda lv: _mix_sql(lv, "fills", "done_amt", "done_amount"),
       lambda spark, sf, o: A.client_type_mix(A.per_account(S.fills(spark, sf), ["done_amt"], S.calendar(spark, sf)), o, "done_amt", "done_amount"))


def _income_mix_sql(lv: str) -> str:
    return with_(*I.BROKERAGE_NEEDS, f"org_{lv}", **I.BROKERAGE_PARTS, g=f"""
  SELECT org_id, busi_month AS period, round(sum(feature_income_total), 4) AS total, {_kind_sums('feature_income_total')}
  FROM brokerage b JOIN accounts a ON a.fund_account_id = b.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""", m=f"""
  SELECT org_id, period, {", ".join(f"{ratio(f's{t}', 'total', ' * 100')} AS x{t}" for t in KINDS)} FROM g""") + f"""
SELECT m.org_id, m.period, {", ".join(f"m.x{t} AS qh_income_{t}, {yoy(f'm.x{t}', f'l.x{t}')} AS qh_income_{t}_yoy" for t in KINDS)}
FROM m LEFT JOIN m l ON l.org_id = m.org_id AND l.period = {back('m.period')}"""


def client_income_mix(spark, sf, o):
    rows = I.brokerage_rows(spark, sf).select("fund_account_id", F.col("busi_month").alias("period"), "feature_income_total")
    return A.client_type_mix(rows, o, "feature_income_total", "qh_income")


def _new_mix_sql(lv: str) -> str:
    return with_("client_sett", "tradedays", "accounts", f"org_{lv}", g=f"""
  SELECT org_id, month AS period, round(sum(rights), 4) AS total, {_kind_sums('rights')} FROM client_sett s JOIN tradedays t USING (busi_date)
  JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id WHERE {NEW.format(p='month')} GROUP BY 1, 2""") + f"""
SELECT org_id, period, {", ".join(f"{ratio(f's{t}', 'total', ' * 100')} AS new_rights_{t}" for t in KINDS)} FROM g"""


def new_client_equity_mix(spark, sf, o):
    return A.new_client_type_mix(A.per_account(S.client_sett(spark, sf), ["rights"], S.calendar(spark, sf)), o, "rights", "new_rights")


for _name, _sql, _fn in (("client_income_mix", _income_mix_sql, client_income_mix), ("new_client_equity_mix", _new_mix_sql, new_client_equity_mix)):
    for _lv in LEVELS:  # the unit's report has no suffix
        query(_name if _lv == "unit" else f"{_name}_by_{_lv}", _sql(_lv))(lambda spark, sf, lv=_lv, fn=_fn: fn(spark, sf, org(spark, sf, lv)))


levels("equity_increment", lambda lv: with_("client_sett", "daymap", "accounts", f"org_{lv}", d="""
  SELECT strftime(busi_date, '%Y') AS year, CAST(sum(trade_flag) AS BIGINT) AS days FROM daymap GROUP BY 1""", g=f"""
  SELECT org_id, strftime(s.busi_date, '%Y') AS period, round(sum(rights), 2) AS total, max(days) AS days,
         round(coalesce(sum(CASE WHEN strftime(open_date, '%Y') = strftime(s.busi_date, '%Y') THEN rights END), 0), 2) AS fresh,
         round(coalesce(sum(CASE WHEN strftime(open_date, '%Y') < strftime(s.busi_date, '%Y') THEN rights END), 0), 2) AS old
  FROM client_sett s JOIN daymap m ON m.busi_date = s.busi_date AND m.trade_flag = 1 JOIN d ON d.year = strftime(s.busi_date, '%Y')
  JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2""") + """
SELECT g.org_id, g.period, g.fresh / g.days / 10000 AS rights_add_new, (g.old / g.days - coalesce(l.total / l.days, 0)) / 10000 AS rights_add_old
FROM g LEFT JOIN g l ON l.org_id = g.org_id AND l.period = CAST(CAST(g.period AS INTEGER) - 1 AS VARCHAR)""",
       lambda spark, sf, o: A.equity_increment(S.client_sett(spark, sf), o, S.calendar(spark, sf)))

BANDS = {"60": "birth <= DATE '1969-12-31'", "70": "birth BETWEEN DATE '1970-01-01' AND DATE '1979-12-31'", "80": "birth BETWEEN DATE '1980-01-01' AND DATE '1989-12-31'",
         "90": "birth BETWEEN DATE '1990-01-01' AND DATE '1999-12-31'", "00": "birth >= DATE '2000-01-01'"}
levels("age_structure", lambda lv: with_("fills", "accounts", f"org_{lv}", aged=BIRTH_SQL, t=f"""
  SELECT DISTINCT org_id, strftime(busi_date, '%Y%m') AS period, a.fund_account_id, birth, open_date FROM fills s JOIN aged a ON a.fund_account_id = s.fund_account_id
  JOIN org_{lv} o ON o.branch_id = a.branch_id""", n=f"""
  SELECT org_id, fund_account_id, birth, min(period) AS period FROM t WHERE {NEW.format(p='period')} GROUP BY 1, 2, 3""") + f"""
SELECT m.*, {", ".join(f"(SELECT count(*) FROM n WHERE n.org_id = m.org_id AND substr(n.period, 1, 4) = substr(m.period, 1, 4) AND n.period <= m.period AND {c}) AS age_{b}_new" for b, c in BANDS.items())}
FROM (SELECT org_id, period, {", ".join(f"count(CASE WHEN {c} THEN 1 END) AS age_{b}" for b, c in BANDS.items())} FROM t GROUP BY 1, 2) m""",
       lambda spark, sf, o: A.age_structure(S.fills(spark, sf), o, S.calendar(spark, sf)))


# ---- brokerage summary ----------------------------------------------------------------------------------

@query("brokerage_summary", with_("statement", "books", "of_unit", "side", "units", "months", "client_sett", "tradedays", "agreements", *I.STAFF_NEEDS,
                                 **I.COOP_SUMMARY, **I.STAFF, sp="SELECT departmentid AS org_id, month AS period FROM units CROSS JOIN months", led="""
  SELECT oa_branch_id AS org_id, month_id AS period, round(sum(b6), 2) AS b6, round(sum(b8), 2) AS b8, round(sum(b7), 2) AS b7 FROM statement JOIN books USING (book_id) GROUP BY 1, 2""", sd=f"""
  SELECT oa_branch_id AS org_id, period, round(sum(p), 2) AS trans_consult_income,
         round(sum(CASE WHEN share = '1' THEN {SIDE_FEE} END), 6) AS sales_income, round(sum(p4), 2) AS out_option_income,
         round(sum(p), 2) AS notional_principal, round(sum(p10), 2) AS royalty,
         round(sum(p), 2) AS product_inventory, round(sum(CASE WHEN trade IN ('0', '1') THEN p END), 2) AS product_new FROM side GROUP BY 1, 2""", cl="""
  SELECT org_id, month AS period, round(sum(rights), 2) AS end_rights FROM client_sett s JOIN tradedays t ON t.busi_date = s.busi_date AND t.last_trade = s.busi_date
  JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_unit o ON o.branch_id = a.branch_id GROUP BY 1, 2""", ib="""
  SELECT org_id, period, round(sum(e), 6) AS ib_end_rights, round(sum(v), 6) AS ib_avg_rights FROM (SELECT oa_branch_id AS org_id, month_id AS period, end_rights AS e, avg_rights AS v FROM staff
    UNION ALL SELECT o.org_id, month_id, end_rights, avg_rights FROM coop c JOIN org_unit o ON o.branch_id = c.branch_id) GROUP BY 1, 2""") + """
SELECT sp.org_id, sp.period, coalesce(b6, 0) AS remain_transfee_income, coalesce(b8, 0) AS market_reduce_income, coalesce(b7, 0) AS clear_interest_income,
       round(coalesce(b6, 0) + coalesce(b8, 0) + coalesce(b7, 0), 2) AS futu_income, coalesce(trans_consult_income, 0) AS trans_consult_income, coalesce(sales_income, 0) AS sales_income,
       coalesce(out_option_income, 0) AS out_option_income, coalesce(notional_principal, 0) AS notional_principal, coalesce(royalty, 0) AS royalty,
       coalesce(end_rights, 0) AS end_rights, coalesce(product_inventory, 0) AS product_inventory, coalesce(product_new, 0) AS product_new,
       coalesce(ib_end_rights, 0) AS ib_end_rights, coalesce(ib_avg_rights, 0) AS ib_avg_rights
FROM sp LEFT JOIN led USING (org_id, period) LEFT JOIN sd USING (org_id, period) LEFT JOIN cl USING (org_id, period) LEFT JOIN ib USING (org_id, period)""")
def brokerage_summary(spark, sf):
    sales, advisory, options, *_ = side_frames(spark, sf)
    coop, staff, _ = brokers(spark, sf)
    lines = L.statement(spark, sf).select(F.col("month_id").alias("period"), "book_id", "b6", "b7", "b8").join(S.books(spark, sf), "book_id")
    return A.brokerage_summary(spots(spark, sf), lines, advisory, options, S.client_sett(spark, sf), sales, coop, staff, org(spark, sf), S.calendar(spark, sf))
