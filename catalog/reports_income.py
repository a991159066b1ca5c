"""Product, brokerage, cooperation, resident-staff and investment income."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import query
from catalog.reports_settlement import FEE_DAY
from catalog.standins import cents, cte, table, with_
from marginbook.functions import dates as D
from marginbook.functions import measures as M
from marginbook.operators import joins as J
from marginbook.plans import income, settlement

# ---- further stand-ins --------------------------------------------------------------------------


def product_code(k):
    return F.concat(F.lit("P"), (k % 40).cast("string"))


def values(spark, sf):
    return S.client_sett(spark, sf).select(
        "busi_date", "fund_account_id", F.col("rights").alias("all_ri_amt"), F.col("yes_rights").alias("today_ri_amt"),
        F.col("transfee").alias("subsistence_fee_amt"), F.col("margin").alias("calint_amt"),
        F.col("market_transfee").alias("exchangeret_amt"), F.col("strikefee").alias("i_int_amt"),
        F.col("delivery_transfee").alias("i_exchangeret_amt"))


def product_accounts(spark, sf):
    """An account trades for one product in even years and for another in odd ones."""
    k, day = F.col("o_custkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        k.alias("fund_account_id"), D.month_key(day).alias("busi_month"), product_code(k + 20 * (F.year(day) % 2)).alias("filing_code")).distinct()


cte("product_accounts", """
SELECT DISTINCT o_custkey AS fund_account_id, strftime(o_orderdate, '%Y%m') AS busi_month,
       'P' || CAST((o_custkey + 20 * (year(o_orderdate) % 2)) % 40 AS VARCHAR) AS filing_code FROM orders""")


def products(spark, sf):
    """Products listed in a month: those with an order then; even codes are funds of funds."""
    k = F.col("o_custkey")
    return (table(spark, sf, "orders")
            .groupBy(D.month_key("o_orderdate").alias("busi_month"), product_code(k).alias("filing_code"),
                     F.when(k % 2 == 0, "FOF fund").otherwise("Plain fund").alias("product_name"))
            .agg(M.money_sum("o_totalprice").alias("product_total_share"), M.money_sum(cents(F.col("o_totalprice") * 0.03)).alias("manage_fee_income"),
                 M.money_sum(cents(F.col("o_totalprice") * 0.01)).alias("sales_incentives")))


cte("products", """
SELECT strftime(o_orderdate, '%Y%m') AS busi_month, 'P' || CAST(o_custkey % 40 AS VARCHAR) AS filing_code,
       CASE WHEN o_custkey % 2 = 0 THEN 'FOF fund' ELSE 'Plain fund' END AS product_name,
       round(sum(o_totalprice), 2) AS product_total_share,
       round(sum(floor(o_totalprice * 0.03::DOUBLE * 100) / 100), 2) AS manage_fee_income,
       round(sum(floor(o_totalprice * 0.01::DOUBLE * 100) / 100), 2) AS sales_incentives
FROM orders GROUP BY 1, 2, 3""")


def parameters(spark, sf):
    r = F.col("r_regionkey")
    return table(spark, sf, "region").select(
        F.concat((r + 1995).cast("string"), F.lit("01")).alias("begin_month"), F.concat((r + 1995).cast("string"), F.lit("12")).alias("end_month"),
        (F.lit(0.06) + r / 100).alias("tax_rate"), (F.lit(0.02) + r / 200).alias("interest_rate"))


cte("parameters", """
SELECT CAST(r_regionkey + 1995 AS VARCHAR) || '01' AS begin_month, CAST(r_regionkey + 1995 AS VARCHAR) || '12' AS end_month,
       0.06::DOUBLE + r_regionkey / 100 AS tax_rate, 0.02::DOUBLE + r_regionkey / 200 AS interest_rate FROM region""")
cte("tradedays", "SELECT d.busi_date, m.* FROM daymap d JOIN months m ON m.month = d.month WHERE trade_flag = 1", "daymap", "months")


def allocation(spark, sf):
    """Five units share each product, a fifth each."""
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.concat(F.lit("P"), (n % 5 + j * 5).cast("string")))).alias("filing_code"),
        F.col("n_name").alias("alloca_oa_branch_id"), F.lit(0.2).alias("alloca_rate"))


cte("allocation", """
SELECT 'P' || CAST(n_nationkey % 5 + j * 5 AS VARCHAR) AS filing_code, n_name AS alloca_oa_branch_id, 0.2::DOUBLE AS alloca_rate
FROM nation, (SELECT unnest(range(8)) AS j)""")


def rebates(spark, sf):
    s = S.client_sett(spark, sf)
    return s.select("fund_account_id", F.col("busi_date").alias("tx_dt"), F.col("transfee").alias("exchange_txfee_amt"),
                    F.col("market_transfee").alias("ret_fee_amt"), F.col("margin").alias("ret_fee_amt_czce"),
                    F.col("market_margin").alias("ret_fee_amt_dce"), F.col("fund_in").alias("ret_fee_amt_shfe1"),
                    F.col("strikefee").alias("investor_ret_amt"))


REBATE_ROWS = """
  SELECT fund_account_id, busi_date AS tx_dt, transfee AS c1, market_transfee AS c2, margin AS p1, market_margin AS p2,
         fund_in AS p3, strikefee AS c3 FROM client_sett"""


def _rebate_sql(trading: bool, dce: str) -> str:
    days = "WHERE trade_flag = 1" if trading else ""
    return f"""
  SELECT w.month, r.fund_account_id, round(sum(CASE WHEN kind = 'c' THEN c1 + c2 + c3 ELSE p1 + p3 END
         + CASE WHEN {dce} THEN p2 ELSE 0 END), 4) AS market_reduct
  FROM rebate_rows r JOIN (
    SELECT month, 'c' AS kind, min(busi_date) AS lo, max(busi_date) AS hi FROM daymap {days} GROUP BY 1
    UNION ALL SELECT month, 'p', CAST(min(busi_date) - INTERVAL 1 MONTH AS DATE), CAST(max(busi_date) - INTERVAL 1 MONTH AS DATE)
    FROM daymap {days} GROUP BY 1) w ON r.tx_dt BETWEEN w.lo AND w.hi GROUP BY 1, 2"""


def agreements(spark, sf):
    k = F.col("c_custkey")
    return (table(spark, sf, "customer")
            .select(k.alias("fund_account_id"), F.date_add(F.lit(date(1995, 6, 1)), (k * 19 % 1500).cast("int")).alias("regist_date"),
                    F.when(k % 3 == 2, "2").otherwise("1").alias("service_type"), F.col("c_nationkey").alias("branch_id"),
                    ((k % 5 + 1) / 10).alias("coope_income_reate"),
                    F.explode(F.when(k % 8 == 0, F.array(F.lit("s1"), F.lit("s2"))).otherwise(F.array(F.lit("s1")))).alias("futu_service_name")))


cte("agreements", """
SELECT c_custkey AS fund_account_id, DATE '1995-06-01' + CAST(c_custkey * 19 % 1500 AS INTEGER) AS regist_date,
       CASE WHEN c_custkey % 3 = 2 THEN '2' ELSE '1' END AS service_type, c_nationkey AS branch_id,
       (c_custkey % 5 + 1) / 10 AS coope_income_reate, s AS futu_service_name
FROM customer, (SELECT unnest(['s1', 's2']) AS s) WHERE s = 's1' OR c_custkey % 8 = 0""")


def interest_rows(spark, sf):
    return S.client_sett(spark, sf).select(
        "busi_date", "fund_account_id", F.col("margin").alias("calint_amt"), F.col("rights").alias("today_ri_amt"),
        F.col("transfee").alias("int_amt_d"), F.when(F.col("fund_account_id") % 2 == 0, 360).otherwise(365).alias("calint_days"))


def journal(spark, sf):
    return S.client_sett(spark, sf).select(
        "busi_date", "fund_account_id", F.when(F.col("sett_type") == "O", "3").otherwise("1").alias("fund_type"),
        F.when(F.col("fund_out") > 0, "1").otherwise("0").alias("fund_direct"), F.col("transfee").alias("occur_money"))


RETAINED_SQL = "transfee + delivery_transfee + strikefee - (market_transfee + market_delivery_transfee + market_strikefee)"
NET_INTEREST_SQL = """
  SELECT month, fund_account_id, round(sum(base * interest_rate * natural_days / calint_days - paid), 2) AS interest FROM (
    SELECT m.month, fund_account_id, calint_days, interest_rate, round(sum(margin), 2) AS base, round(sum(transfee), 2) AS paid,
           max(natural_days) AS natural_days
    FROM (SELECT *, CASE WHEN fund_account_id % 2 = 0 THEN 360 ELSE 365 END AS calint_days FROM client_sett) s
    JOIN rates ON busi_date BETWEEN begin_date AND end_date JOIN months m ON m.month = strftime(busi_date, '%Y%m')
    GROUP BY 1, 2, 3, 4) GROUP BY 1, 2"""
PAYOUT_SQL = """
  SELECT strftime(busi_date, '%Y%m') AS month, fund_account_id, round(sum(transfee), 2) AS occur FROM client_sett
  WHERE sett_type = 'O' AND fund_out > 0 GROUP BY 1, 2"""

# ---- queries ----------------------------------------------------------------------------------------

PRODUCT_PARTS = dict(acc="""
  SELECT month AS busi_month, fund_account_id, round(sum(rights), 2) AS sum_rights,
         round(coalesce(sum(CASE WHEN s.busi_date = last_trade THEN yes_rights END), 0), 2) AS end_rights,
         round(sum(transfee), 2) AS fee, round(sum(margin), 2) AS base, round(sum(market_transfee), 2) AS reduct,
         round(sum(strikefee), 2) AS ret_interest, round(sum(delivery_transfee), 2) AS ret_reduct, max(trade_days) AS days
  FROM client_sett s JOIN tradedays t USING (busi_date) GROUP BY 1, 2""", prod="""
  SELECT busi_month, filing_code, round(sum(end_rights), 2) AS end_rights, round(sum(sum_rights), 2) AS sum_rights,
         round(sum(base), 2) AS interest_base, round(sum(fee), 2) AS clear_remain_transfee, round(sum(reduct), 2) AS market_reduct,
         round(sum(ret_reduct), 2) AS client_ret_marreduct, round(sum(ret_interest), 2) AS client_ret_interest,
         round(sum(sum_rights), 2) / max(days) AS avg_rights
  FROM acc JOIN product_accounts USING (fund_account_id, busi_month) GROUP BY 1, 2""")
PRODUCT_TAIL = """
  clear_remain_transfee / (1 + tax) AS clear_remain_transfee_extax, market_reduct / (1 + tax) AS market_reduct_extax,
  client_ret_marreduct / (1 + tax) AS client_ret_marreduct_extax, interest_base * (1 + intr) / 360 AS interest_income,
  clear_remain_transfee / (1 + tax) + market_reduct / (1 + tax) + interest_base * (1 + intr) / 360
    - client_ret_marreduct / (1 + tax) - client_ret_interest AS total_futu_income"""
FOF_PART = """
  SELECT p.busi_month, p.filing_code, p.product_name, p.manage_fee_income, p.sales_incentives, a.* EXCLUDE (busi_month, filing_code),
         coalesce(tax_rate, 1) AS tax, coalesce(interest_rate, 1) AS intr
  FROM products p LEFT JOIN prod a ON a.busi_month = p.busi_month AND a.filing_code = p.filing_code
  LEFT JOIN parameters ON p.busi_month BETWEEN begin_month AND end_month WHERE product_name LIKE '%FOF%'"""


def _product_income(spark, sf, fof):
    return income.product_income(values(spark, sf), product_accounts(spark, sf), products(spark, sf), parameters(spark, sf),
                                 S.calendar(spark, sf), fof, products(spark, sf) if fof else None)


@query("fund_of_funds_income", with_("client_sett", "tradedays", "product_accounts", "products", "parameters", **PRODUCT_PARTS, j=FOF_PART) + f"""
SELECT j.* EXCLUDE (tax, intr), manage_fee_income / (1 + tax) AS manage_fee_income_extax, {PRODUCT_TAIL} FROM j""")
def fund_of_funds_income(spark, sf):
    return _product_income(spark, sf, True)


@query("ordinary_product_income", with_("client_sett", "tradedays", "product_accounts", "products", "parameters", **PRODUCT_PARTS, j="""
  SELECT coalesce(p.busi_month, a.busi_month) AS busi_month, coalesce(p.filing_code, a.filing_code) AS filing_code, p.product_name,
         coalesce(end_rights, 0) AS end_rights, coalesce(sum_rights, 0) AS sum_rights, coalesce(interest_base, 0) AS interest_base,
         coalesce(clear_remain_transfee, 0) AS clear_remain_transfee, coalesce(market_reduct, 0) AS market_reduct,
         coalesce(client_ret_marreduct, 0) AS client_ret_marreduct, coalesce(client_ret_interest, 0) AS client_ret_interest,
         coalesce(avg_rights, 0) AS avg_rights
  FROM (SELECT * FROM products WHERE product_name NOT LIKE '%FOF%') p FULL JOIN prod a ON a.busi_month = p.busi_month AND a.filing_code = p.filing_code""", k="""
  SELECT j.*, coalesce(tax_rate, 1) AS tax, coalesce(interest_rate, 1) AS intr FROM j LEFT JOIN parameters ON busi_month BETWEEN begin_month AND end_month""") + f"""
SELECT k.* EXCLUDE (tax, intr), {PRODUCT_TAIL} FROM k""")
def ordinary_product_income(spark, sf):
    return _product_income(spark, sf, False)


@query("income_allocation", with_("client_sett", "tradedays", "product_accounts", "products", "parameters", "allocation", **PRODUCT_PARTS, j=FOF_PART, k=f"""
  SELECT j.*, manage_fee_income / (1 + tax) AS manage_fee_income_extax, {PRODUCT_TAIL} FROM j""") + """
SELECT busi_month, filing_code, product_name, alloca_oa_branch_id, total_futu_income * alloca_rate AS total_futu_income,
       sales_incentives * alloca_rate AS sales_incentives, manage_fee_income_extax * alloca_rate AS manage_fee_income_extax,
       interest_income * alloca_rate AS interest_income FROM k JOIN allocation USING (filing_code)""")
def income_allocation(spark, sf):
    measures = ["total_futu_income", "sales_incentives", "manage_fee_income_extax", "interest_income"]
    income_rows = _product_income(spark, sf, True).select("busi_month", "filing_code", "product_name", *measures)
    return J.allocate(income_rows, allocation(spark, sf), ["filing_code"], measures)


def fof_inputs(spark, sf):
    k, o = F.col("c_custkey"), F.col("o_custkey")
    confirms = table(spark, sf, "orders").select(
        S.weekday_only(F.col("o_orderdate")).alias("busi_date"), product_code(o).alias("filing_code"),
        F.concat(F.lit("C"), o.cast("string")).alias("client_name"), F.col("o_totalprice").alias("confirm_share"))
    sellers = table(spark, sf, "customer").select(
        product_code(k).alias("filing_code"), F.concat(F.lit("C"), k.cast("string")).alias("client_name"),
        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("oa_branch_id"), F.concat(F.lit("S"), (k % 7).cast("string")).alias("oa_broker_name"),
        ((k % 4 + 1) / 4).alias("oa_broker_name_rate"))
    advisers = sellers.select("filing_code", "oa_branch_id", "oa_broker_name").distinct().select(
        "*", F.lit(0.3).alias("oa_branch_advisor_rate"), F.lit(0.5).alias("oa_broker_advisor_rate"))
    return confirms, products(spark, sf), sellers, advisers


cte("confirms", f"""
SELECT {S._rolled('o_orderdate')} AS busi_date, 'P' || CAST(o_custkey % 40 AS VARCHAR) AS filing_code,
       'C' || CAST(o_custkey AS VARCHAR) AS client_name, o_totalprice AS confirm_share FROM orders""")
cte("sellers", """
SELECT 'P' || CAST(c_custkey % 40 AS VARCHAR) AS filing_code, 'C' || CAST(c_custkey AS VARCHAR) AS client_name,
       'NATION_' || CAST(c_custkey % 25 AS VARCHAR) AS oa_branch_id, 'S' || CAST(c_custkey % 7 AS VARCHAR) AS oa_broker_name,
       (c_custkey % 4 + 1) / 4 AS rate FROM customer""")
FOF_SHARES = dict(held="""
  SELECT month AS period, filing_code, client_name, round(sum(confirm_share), 2) AS client_share FROM confirms JOIN tradedays USING (busi_date) GROUP BY 1, 2, 3""", lastshare="""
  SELECT filing_code, product_total_share FROM (SELECT *, row_number() OVER (PARTITION BY filing_code ORDER BY busi_month DESC) AS rn FROM products) WHERE rn = 1""", sold="""
  SELECT period, filing_code, oa_branch_id, oa_broker_name, round(sum(client_share), 2) AS sales_share,
         CASE WHEN max(product_total_share) <> 0 THEN round(sum(client_share * rate), 4) / max(product_total_share) ELSE 0 END AS prop
  FROM held JOIN sellers USING (filing_code, client_name) LEFT JOIN lastshare USING (filing_code) GROUP BY 1, 2, 3, 4""", equity="""
  SELECT month AS period, filing_code, round(sum(rights), 2) / max(trade_days) AS avg_rights
  FROM client_sett s JOIN tradedays USING (busi_date) JOIN product_accounts p ON p.fund_account_id = s.fund_account_id AND p.busi_month = month GROUP BY 1, 2""", fofshare="""
  SELECT e.period, e.filing_code, a.oa_branch_id, a.oa_broker_name,
         avg_rights * (1 - 0.3::DOUBLE) * coalesce(prop, 0) AS sales_product_avg_rights, avg_rights * 0.3::DOUBLE * 0.5::DOUBLE AS advisor_avg_rights,
         avg_rights * (1 - 0.3::DOUBLE) * coalesce(prop, 0) + avg_rights * 0.3::DOUBLE * 0.5::DOUBLE AS sum_avg_rights,
         coalesce(sales_share, 0) AS sales_share, avg_rights AS fof_avg_rights
  FROM equity e JOIN (SELECT DISTINCT filing_code, oa_branch_id, oa_broker_name FROM sellers) a ON a.filing_code = e.filing_code
  LEFT JOIN sold s ON s.period = e.period AND s.filing_code = e.filing_code AND s.oa_branch_id = a.oa_branch_id AND s.oa_broker_name = a.oa_broker_name""")


@query("fund_of_funds_shares", with_("confirms", "tradedays", "products", "sellers", "client_sett", "product_accounts", **FOF_SHARES) + "SELECT * FROM fofshare")
def fund_of_funds_shares(spark, sf):
    confirms, prods, sellers, advisers = fof_inputs(spark, sf)
    return income.fund_of_funds_shares(confirms, prods, sellers, advisers, S.client_sett(spark, sf), product_accounts(spark, sf), S.calendar(spark, sf))


BROKERAGE_PARTS = dict(rebate_rows=REBATE_ROWS, reb=_rebate_sql(True, "kind = 'p'"), base="""
  SELECT busi_date, fund_account_id, round(sum(rights - greatest(impawn_money, margin)), 2) AS base FROM client_sett GROUP BY 1, 2""", carried="""
  SELECT trade_date AS busi_date, count(*) AS carried FROM daymap WHERE trade_date IS NOT NULL GROUP BY 1""", intr="""
  SELECT strftime(busi_date, '%Y%m') AS month, fund_account_id, round(sum(base * carried * interest_rate / 36000), 2) AS interest
  FROM base JOIN carried USING (busi_date) JOIN rates ON busi_date BETWEEN begin_date AND end_date GROUP BY 1, 2""", fee=f"""
  SELECT month, fund_account_id, round(sum({RETAINED_SQL}), 2) AS fee FROM client_sett JOIN tradedays USING (busi_date) GROUP BY 1, 2""", brok="""
  SELECT month AS busi_month, fund_account_id, round(coalesce(sum(fee), 0), 4) AS remain_transfee, round(coalesce(sum(interest), 0), 4) AS interest_income,
         round(coalesce(sum(market_reduct), 0), 4) AS market_reduct
  FROM (SELECT month, fund_account_id, fee FROM fee UNION ALL BY NAME SELECT month, fund_account_id, interest FROM intr
        UNION ALL BY NAME SELECT month, fund_account_id, market_reduct FROM reb) GROUP BY 1, 2""", brokerage="""
  SELECT b.*, a.branch_id, round(remain_transfee + interest_income + market_reduct, 4) AS feature_income_total
  FROM brok b JOIN accounts a USING (fund_account_id) WHERE round(remain_transfee + interest_income + market_reduct, 4) <> 0""")
BROKERAGE_NEEDS = ("client_sett", "daymap", "tradedays", "rates", "accounts")


def brokerage_rows(spark, sf):
    return income.brokerage_income(S.client_sett(spark, sf), S.rates(spark, sf), rebates(spark, sf), S.accounts(spark, sf), S.calendar(spark, sf))


query("brokerage_income", with_(*BROKERAGE_NEEDS, **BROKERAGE_PARTS) + "SELECT * FROM brokerage")(brokerage_rows)

COOP_PARTS = dict(rebate_rows=REBATE_ROWS, reb=_rebate_sql(False, "TRUE"), intr=NET_INTEREST_SQL, pay=PAYOUT_SQL)


@query("cooperation_income", with_("client_sett", "daymap", "months", "rates", "accounts", "agreements", **COOP_PARTS, starts="""
  SELECT fund_account_id, min(regist_date) AS start FROM agreements WHERE service_type = '1' GROUP BY 1""", fee=f"""
  SELECT strftime(busi_date, '%Y%m') AS month, fund_account_id, round(sum({RETAINED_SQL}), 2) AS fee
  FROM client_sett JOIN starts USING (fund_account_id) WHERE busi_date >= start GROUP BY 1, 2""") + """
SELECT f.month AS month_id, a.branch_id, round(sum((fee + coalesce(interest, 0) + coalesce(market_reduct, 0) - coalesce(occur, 0)) * coope_income_reate), 4) AS xt_income
FROM fee f LEFT JOIN intr i ON i.month = f.month AND i.fund_account_id = f.fund_account_id
LEFT JOIN reb r ON r.month = f.month AND r.fund_account_id = f.fund_account_id
LEFT JOIN pay p ON p.month = f.month AND p.fund_account_id = f.fund_account_id
JOIN (SELECT DISTINCT fund_account_id, coope_income_reate FROM agreements WHERE service_type = '1') s ON s.fund_account_id = f.fund_account_id
LEFT JOIN accounts a ON a.fund_account_id = f.fund_account_id GROUP BY 1, 2""")
def cooperation_income(spark, sf):
    return income.cooperation_income(agreements(spark, sf), S.client_sett(spark, sf), interest_rows(spark, sf), S.rates(spark, sf),
                                     rebates(spark, sf), journal(spark, sf), S.accounts(spark, sf), S.calendar(spark, sf))


@query("resident_income", with_("client_sett", "daymap", "months", "rates", "accounts", "relations", **COOP_PARTS, served="""
  SELECT * FROM relations WHERE rela_sts = 'A' AND approve_sts = '0' AND broker_id LIKE 'ZD%'""", starts="""
  SELECT fund_account_id, min(st_dt) AS start, sum(coalesce(data_pct, 0)) AS pct, count(*) AS n FROM served GROUP BY 1""", f=FEE_DAY, fee="""
  SELECT strftime(busi_date, '%Y%m') AS month, fund_account_id, round(sum(net_fee), 2) AS fee
  FROM f JOIN starts USING (fund_account_id) WHERE busi_date >= start GROUP BY 1, 2""") + """
SELECT f.month AS month_id, a.branch_id, round(sum(coalesce(interest, 0) * pct + (coalesce(market_reduct, 0) - coalesce(occur, 0) + fee) * n), 4) AS zd_income
FROM fee f LEFT JOIN intr i ON i.month = f.month AND i.fund_account_id = f.fund_account_id
LEFT JOIN reb r ON r.month = f.month AND r.fund_account_id = f.fund_account_id
LEFT JOIN pay p ON p.month = f.month AND p.fund_account_id = f.fund_account_id
JOIN starts s ON s.fund_account_id = f.fund_account_id
LEFT JOIN accounts a ON a.fund_account_id = f.fund_account_id GROUP BY 1, 2""")
def resident_income(spark, sf):
    from catalog.reports_settlement import investor_values
    recon = settlement.net_retained_fees(investor_values(spark, sf))
    return income.resident_income(S.relations(spark, sf), recon, interest_rows(spark, sf), S.rates(spark, sf), rebates(spark, sf),
                                  journal(spark, sf), S.accounts(spark, sf), S.calendar(spark, sf))


COOP_SUMMARY = dict(m=f"""
  SELECT month, fund_account_id, round(coalesce(sum(CASE WHEN s.busi_date = first_trade THEN yes_rights END), 0), 2) AS yes_rights,
         round(coalesce(sum(CASE WHEN s.busi_date = last_trade THEN rights END), 0), 2) AS end_rights, round(sum(rights), 2) AS sum_rights,
         round(sum({RETAINED_SQL}), 2) AS fee, max(trade_days) AS days FROM client_sett s JOIN tradedays t USING (busi_date) GROUP BY 1, 2""", coop="""
  SELECT t.month AS month_id, t.branch_id, yes_rights, end_rights, sum_rights / days AS avg_rights, remain_transfee, coope_income FROM (
    SELECT month, branch_id, round(sum(yes_rights), 2) AS yes_rights, round(sum(end_rights), 2) AS end_rights, round(sum(sum_rights), 2) AS sum_rights,
           round(sum(fee), 2) AS remain_transfee, max(days) AS days
    FROM m JOIN (SELECT DISTINCT fund_account_id, regist_date, branch_id FROM agreements WHERE service_type = '1') USING (fund_account_id) GROUP BY 1, 2) t
  LEFT JOIN (SELECT month, branch_id, round(sum(fee * coope_income_reate), 4) AS coope_income FROM m
    JOIN (SELECT * FROM agreements WHERE service_type = '1') USING (fund_account_id) GROUP BY 1, 2) c ON c.month = t.month AND c.branch_id = t.branch_id""")


@query("cooperation_summary", with_("client_sett", "tradedays", "agreements", **COOP_SUMMARY) + "SELECT * FROM coop")
def cooperation_summary(spark, sf):
    return income.cooperation_summary(agreements(spark, sf), S.client_sett(spark, sf), S.calendar(spark, sf))


def investment_inputs(spark, sf):
    k, p = F.col("s_suppkey"), F.col("l_extendedprice")
    begin = F.date_add(F.lit(date(1995, 1, 1)), (k * 7 % 700).cast("int"))
    sup = table(spark, sf, "supplier")
    projects = sup.select(k.alias("project_id"), F.concat(F.lit("S"), k.cast("string")).alias("project_name"),
                          F.concat(F.lit("T"), (k % 3).cast("string")).alias("strategy_type"), begin.alias("begin_date"),
                          F.date_add(begin, (k * 31 % 2000).cast("int")).alias("end_date"))
    item = table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("project_name"), D.month_key("l_shipdate").alias("account_period"),
        "l_returnflag", p.alias("price"))
    results = item.select("project_name", "account_period", F.col("price").alias("total_balance"),
                          cents(F.col("price") * 0.1).alias("changes_begin_value"), cents(F.col("price") * 0.2).alias("changes_end_value"),
                          cents(F.col("price") * 0.05).alias("investment_income"), F.col("price").alias("total_cost"))
    flag = F.col("l_returnflag")
    bal = item.select("project_name", "account_period",
                      F.when(flag == "A", income.COST_ACCOUNT).when(flag == "N", income.CHANGE_ACCOUNT).otherwise("2001").alias("account_code"),
                      F.col("price").alias("local_end_balance"), cents(F.col("price") * 0.8).alias("local_begin_balance"))
    departs = sup.select(k.alias("project_id"), F.explode(F.array(
        F.concat(F.lit("D"), (F.col("s_nationkey") % 5).cast("string")), F.concat(F.lit("A"), F.col("s_nationkey").cast("string")))).alias("recommend_depart"))
    ends = S.calendar(spark, sf).select(D.month_key("busi_date").alias("account_period"), D.month_end("busi_date").alias("month_end")).distinct()
    return projects, results, bal, departs, ends


INVEST = dict(item="""
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS project_name, strftime(l_shipdate, '%Y%m') AS account_period, l_returnflag AS flag, l_extendedprice AS price FROM lineitem""", mon="""
  SELECT project_name, account_period, round(sum(price), 2) AS total_balance, round(sum(floor(price * 0.1::DOUBLE * 100) / 100), 2) AS cb,
         round(sum(floor(price * 0.2::DOUBLE * 100) / 100), 2) AS ce, round(sum(floor(price * 0.05::DOUBLE * 100) / 100), 2) AS inc,
         round(coalesce(sum(CASE WHEN flag = 'A' THEN price END), 0), 2) AS initial_investment_money,
         round(coalesce(sum(CASE WHEN flag IN ('A', 'N') THEN price END), 0), 2) AS month_end_market,
         round(coalesce(sum(CASE WHEN flag = 'N' THEN price END), 0), 2) AS change_end,
         round(coalesce(sum(CASE WHEN flag = 'N' THEN floor(price * 0.8::DOUBLE * 100) / 100 END), 0), 2) AS change_begin,
         bool_or(flag = 'A') AS has_cost, bool_or(flag = 'N') AS has_change FROM item GROUP BY 1, 2""", calc="""
  SELECT *, CASE WHEN has_cost THEN total_balance ELSE 0 END + CASE WHEN has_change THEN cb ELSE 0 END AS bv,
         CASE WHEN has_cost THEN total_balance ELSE 0 END + CASE WHEN has_change THEN ce ELSE 0 END AS ev,
         sum(CASE WHEN has_change THEN inc ELSE 0 END) OVER w AS ytd,
         coalesce(max(CASE WHEN account_period LIKE '%01' THEN change_end END) OVER w, 0) AS jan_change FROM mon
  WINDOW w AS (PARTITION BY project_name, substr(account_period, 1, 4) ORDER BY account_period)""", calc2="""
  SELECT *, coalesce(max(CASE WHEN account_period LIKE '%01' THEN bv END) OVER (PARTITION BY project_name, substr(account_period, 1, 4) ORDER BY account_period), 0) AS year_begin_net_investment,
         round(change_end - jan_change + ytd, 2) AS investment_income, round(change_end - change_begin + CASE WHEN has_change THEN inc ELSE 0 END, 2) AS comprehensive_income,
         CASE WHEN has_cost THEN total_balance ELSE 0 END AS cost FROM calc""", proj="""
  SELECT s_suppkey AS project_id, 'S' || CAST(s_suppkey AS VARCHAR) AS project_name, 'T' || CAST(s_suppkey % 3 AS VARCHAR) AS strategy_type,
         DATE '1995-01-01' + CAST(s_suppkey * 7 % 700 AS INTEGER) AS b,
         DATE '1995-01-01' + CAST(s_suppkey * 7 % 700 AS INTEGER) + CAST(s_suppkey * 31 % 2000 AS INTEGER) AS e,
         'A' || CAST(s_nationkey AS VARCHAR) || '/D' || CAST(s_nationkey % 5 AS VARCHAR) AS recommend_department FROM supplier""")


@query("investment_tracking", with_(**INVEST) + """
SELECT account_period AS busi_month, project_id, c.project_name, strategy_type, recommend_department,
       CAST(least(e, last_day(strptime(account_period || '01', '%Y%m%d'))) - b + 1 AS INTEGER) AS investment_days, year_begin_net_investment,
       ev AS month_end_net_investment, initial_investment_money, month_end_market, comprehensive_income, investment_income, cost,
       CASE WHEN cost <> 0 AND least(e, last_day(strptime(account_period || '01', '%Y%m%d'))) - b + 1 > 0 THEN investment_income / cost / (least(e, last_day(strptime(account_period || '01', '%Y%m%d'))) - b + 1) END AS year_composite_rate
FROM calc2 c JOIN proj USING (project_name)""")
def investment_tracking(spark, sf):
    return income.investment_tracking(*investment_inputs(spark, sf))


STAFF = dict(served="SELECT * FROM relations WHERE rela_sts = 'A' AND approve_sts = '0' AND broker_id LIKE 'ZD%'", eq="""
  SELECT month, fund_account_id, round(coalesce(sum(CASE WHEN s.busi_date = last_trade THEN rights END), 0), 2) AS end_rights, round(sum(rights), 2) AS sum_rights
  FROM client_sett s JOIN tradedays t USING (busi_date) JOIN served r USING (fund_account_id) WHERE s.busi_date BETWEEN st_dt AND end_dt GROUP BY 1, 2""", tr="""
  SELECT month, fund_account_id, round(sum(done_amt), 2) AS done_amt, round(sum(done_sum), 2) AS done_sum
  FROM fills s JOIN tradedays t USING (busi_date) JOIN served r USING (fund_account_id) WHERE s.busi_date BETWEEN st_dt AND end_dt GROUP BY 1, 2""", joint="""
  SELECT coalesce(eq.month, tr.month) AS month, coalesce(eq.fund_account_id, tr.fund_account_id) AS fund_account_id, coalesce(end_rights, 0) AS end_rights,
         coalesce(sum_rights, 0) AS sum_rights, coalesce(done_amt, 0) AS done_amt, coalesce(done_sum, 0) AS done_sum
  FROM eq FULL JOIN tr ON eq.month = tr.month AND eq.fund_account_id = tr.fund_account_id""", staff="""
  SELECT b.month AS month_id, o.org_id AS oa_branch_id, count(*) AS clients, round(sum(end_rights * pct), 4) AS end_rights,
         round(sum(sum_rights * pct), 4) / max(trade_days) AS avg_rights, round(sum(done_amt * pct), 4) AS done_amount, round(sum(done_sum * pct), 4) AS done_money
  FROM joint b JOIN (SELECT fund_account_id, sum(coalesce(data_pct, 1)) AS pct FROM served GROUP BY 1) p USING (fund_account_id)
  JOIN accounts a USING (fund_account_id) JOIN org_unit o ON o.branch_id = a.branch_id JOIN months m ON m.month = b.month GROUP BY 1, 2""")
STAFF_NEEDS = ("client_sett", "fills", "tradedays", "months", "relations", "accounts", "org_unit")


def staff_rows(spark, sf):
    return income.staff_marketing(S.relations(spark, sf), S.client_sett(spark, sf), S.fills(spark, sf), S.accounts(spark, sf),
                                  S.branch_map(spark, sf), S.calendar(spark, sf))


query("staff_marketing", with_(*STAFF_NEEDS, **STAFF) + "SELECT * FROM staff")(staff_rows)
