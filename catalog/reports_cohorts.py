"""Key-client programme."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import reports_analysis as RA, reports_income as I, standins as S
from catalog.operator_queries import BIRTH_SQL, band_sql
from catalog.registry import query
from catalog.standins import cte, table, with_
from marginbook.functions import codes, dates as D
from marginbook.plans import analysis as A, cohorts

OPEN_EDGES = ("1995-12-31", "1996-12-31", "1998-06-30", "2000-12-31")


def members(spark, sf):
    """Accounts tagged in a year: those with an urgent order in it."""
    return (table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
            .select(F.col("o_custkey").alias("fund_account_id"), D.year_key("o_orderdate").alias("period")).distinct())


def values(spark, sf):
    return S.client_sett(spark, sf).select(
        "busi_date", "fund_account_id", F.col("transfee").alias("subsistence_fee_amt"), F.col("margin").alias("int_amt"), F.col("fund_in").alias("oth_amt"),
        F.col("market_transfee").alias("fd_amt"), F.col("strikefee").alias("soft_amt"), F.col("delivery_transfee").alias("staff_amt"))


def overrides(spark, sf):
    """Commission rows that replace the staff commission where a broker's relation is recorded."""
    recorded = F.expr("sett_type = 'P' AND fund_account_id % 3 = 0")
    return S.client_sett(spark, sf).select(
        "busi_date", "fund_account_id", F.when(recorded, F.col("market_delivery_transfee")).alias("ib_amt"), F.lit(None).cast("double").alias("staff_int_amt"))


def contributions(spark, sf, period=D.year_key):
    return cohorts.net_contribution(values(spark, sf), period("busi_date"))


cte("members", "SELECT DISTINCT o_custkey AS fund_account_id, strftime(o_orderdate, '%Y') AS period FROM orders WHERE o_orderpriority = '1-URGENT'")
cte("contrib", """
SELECT fund_account_id, strftime(busi_date, '%Y') AS period, round(sum(transfee + margin + fund_in - (market_transfee + strikefee + delivery_transfee)), 2) AS jgx
FROM client_sett GROUP BY 1, 2""", "client_sett")


@query("net_contribution", with_("client_sett", o="""
  SELECT busi_date, fund_account_id, sum(CASE WHEN sett_type = 'P' AND fund_account_id % 3 = 0 THEN market_delivery_transfee END) AS ib FROM client_sett GROUP BY 1, 2""") + """
SELECT fund_account_id, strftime(busi_date, '%Y%m') AS period,
       round(sum(transfee + margin + fund_in - (market_transfee + strikefee + coalesce(ib, delivery_transfee))), 2) AS jgx
FROM client_sett LEFT JOIN o USING (busi_date, fund_account_id) GROUP BY 1, 2""")
def net_contribution(spark, sf):
    return cohorts.net_contribution(values(spark, sf), D.month_key("busi_date"), overrides(spark, sf))


def _programme_sql(lv: str) -> str:
    kinds = {"0": "client_type = '0'", "1": "client_type = '1'", "3": "client_type IN ('3', '4')"}
    groups = {"1": "now AND was", "2": "now AND was AND strftime(open_date, '%Y') = period", "3": "now AND NOT was AND strftime(open_date, '%Y') < period",
              "4": "now AND NOT was AND strftime(open_date, '%Y') >= period"}
    s = lambda c, v: f"round(coalesce(sum(CASE WHEN {c} THEN {v} END), 0), 2)"
    n = lambda c: f"count(CASE WHEN {c} THEN 1 END)"
    r = RA.ratio
    aggs = ", ".join([f"{n('now')} AS num_all", f"{s('now', 'jgx')} AS jgx_all", f"{s('now', 'rights')} AS rights_all", f"{s('now', 'fee')} AS fee_all"]
                     + [f"{n(f'now AND {c}')} AS cn_{t}, {s(f'now AND {c}', 'jgx')} AS j_{t}, {s(f'now AND {c}', 'rights')} AS r_{t}, {s(f'now AND {c}', 'fee')} AS f_{t}" for t, c in kinds.items()]
                     + [f"{n(c)} AS n_{g}, {s(c, 'jgx')} AS s_{g}" for g, c in groups.items()]
                     + [f"{n('was')} AS last_num, {s('was', 'last_jgx')} AS last_sum, {n('was AND NOT now')} AS lost_num, {s('was AND NOT now', 'last_jgx')} AS lost_sum, {s('now AND was', 'last_jgx')} AS kept_last"])
    out = ", ".join([f"{r(f'r_{t}', 'days')} AS avg_rights_{t}, {r(f'r_{t}', 'rights_all')} AS avg_rights_{t}_rate, {r(f'f_{t}', 'days')} AS transfee_{t}, {r(f'f_{t}', 'fee_all')} AS transfee_{t}_rate, "
                     f"cn_{t} AS client_num_{t}, j_{t} / 10000 AS clear_transfee_{t}, {r(f'j_{t}', f'cn_{t}')} AS avg_clear_transfee_{t}" for t in kinds]
                    + [f"n_{g} AS qw_client_num_{g}, {r(f'n_{g}', 'num_all')} AS qw_client_num_{g}_rate, s_{g} AS qw_clear_transfee_{g}, {r(f's_{g}', 'jgx_all')} AS qw_clear_transfee_{g}_rate, "
                       f"{r(f's_{g}', f'n_{g}')} / 10000 AS qw_avg_clear_transfee_{g}" for g in groups])
    return with_("members", "contrib", "client_sett", "daymap", "accounts", f"org_{lv}", mk="""
  SELECT fund_account_id, period, bool_or(n) AS now, bool_or(w) AS was FROM (SELECT *, TRUE AS n, FALSE AS w FROM members
    UNION ALL SELECT fund_account_id, CAST(CAST(period AS INTEGER) + 1 AS VARCHAR), FALSE, TRUE FROM members)
  WHERE period IN (SELECT period FROM members) GROUP BY 1, 2""", fl="""
  SELECT fund_account_id, strftime(s.busi_date, '%Y') AS period, round(sum(rights), 2) AS rights, round(sum(transfee + delivery_transfee + strikefee), 2) AS fee
  FROM client_sett s JOIN daymap d ON d.busi_date = s.busi_date AND trade_flag = 1 GROUP BY 1, 2""", dy="""
  SELECT strftime(busi_date, '%Y') AS period, CAST(sum(trade_flag) AS BIGINT) AS days FROM daymap GROUP BY 1""", j=f"""
  SELECT org_id, m.period, now, was, client_type, open_date, days, coalesce(c.jgx, 0) AS jgx, coalesce(l.jgx, 0) AS last_jgx, coalesce(rights, 0) AS rights, coalesce(fee, 0) AS fee
  FROM mk m LEFT JOIN contrib c ON c.fund_account_id = m.fund_account_id AND c.period = m.period
  LEFT JOIN contrib l ON l.fund_account_id = m.fund_account_id AND l.period = CAST(CAST(m.period AS INTEGER) - 1 AS VARCHAR)
  LEFT JOIN fl f ON f.fund_account_id = m.fund_account_id AND f.period = m.period JOIN dy ON dy.period = m.period
  JOIN accounts a ON a.fund_account_id = m.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id""", g=f"SELECT org_id, period, max(days) AS days, {aggs} FROM j GROUP BY 1, 2") + f"""
SELECT org_id, period, {out}, num_all AS qw_client_num_all, jgx_all AS qw_clear_transfee_all, {r('jgx_all', 'num_all')} / 10000 AS qw_avg_clear_transfee_all,
       last_num AS lose_client_num1, n_1 AS lose_client_num2, {r('n_1', 'last_num')} AS lose_client_num3, lost_num AS lose_client_num4, {r('lost_num', 'last_num')} AS lose_client_num5,
       last_sum AS lose_client_num6, s_1 AS lose_client_num7, {r('s_1', 'last_sum')} AS lose_client_num8, lost_sum AS lose_client_num9, {r('lost_sum', 'last_sum')} AS lose_client_num10,
       CASE WHEN ({r('last_sum', 'last_num')}) <> 0 THEN ({r('jgx_all', 'num_all')}) / ({r('last_sum', 'last_num')}) - 1 ELSE 0 END AS lose_client_num11,
       CASE WHEN ({r('kept_last', 'n_1')}) <> 0 THEN ({r('s_1', 'n_1')}) / ({r('kept_last', 'n_1')}) - 1 ELSE 0 END AS lose_client_num12,
       round(s_1 - kept_last, 2) AS lose_client_num13 FROM g"""


RA.levels("key_client_programme", _programme_sql, lambda spark, sf, o: cohorts.key_client_programme(
    members(spark, sf), S.client_sett(spark, sf), contributions(spark, sf), o, S.calendar(spark, sf)))


@query("key_clients_by_opening_and_age", with_("members", "contrib", "accounts", "org_unit", aged=BIRTH_SQL) + f"""
SELECT org_id, m.period, coalesce({band_sql('open_date', OPEN_EDGES)}, '') AS open_date_flag, coalesce({band_sql('birth', codes.BIRTH_EDGES)}, '') AS age_range,
       count(*) AS client_num, round(sum(coalesce(jgx, 0)), 2) / 10000 AS jgx_sum, round(sum(coalesce(jgx, 0)), 2) / count(*) AS avg_jgx
FROM members m LEFT JOIN contrib c ON c.fund_account_id = m.fund_account_id AND c.period = m.period JOIN aged a ON a.fund_account_id = m.fund_account_id
JOIN org_unit o ON o.branch_id = a.branch_id WHERE client_type = '0' GROUP BY 1, 2, 3, 4""")
def key_clients_by_opening_and_age(spark, sf):
    return cohorts.opening_and_age_bands(members(spark, sf), contributions(spark, sf), RA.org(spark, sf), OPEN_EDGES)


RA.levels("label_cohorts", lambda lv: with_("client_sett", "fills", "tradedays", "accounts", f"org_{lv}", lab="""
  SELECT DISTINCT o_orderpriority AS label_id, o_custkey AS fund_account_id, strftime(o_orderdate, '%Y%m') AS period FROM orders""", e="""
  SELECT fund_account_id, month AS period, round(sum(rights), 2) AS rights FROM client_sett JOIN tradedays USING (busi_date) GROUP BY 1, 2""", d="""
  SELECT fund_account_id, month AS period, round(sum(done_amt), 2) AS amt, round(sum(done_sum), 2) AS money FROM fills JOIN tradedays USING (busi_date) GROUP BY 1, 2""", c="""
  SELECT fund_account_id, strftime(busi_date, '%Y%m') AS period, round(sum(transfee + margin + fund_in - (market_transfee + strikefee + delivery_transfee)), 2) AS jgx FROM client_sett GROUP BY 1, 2""", k="""
  SELECT month AS period, max(trade_days) AS days FROM tradedays GROUP BY 1""") + f"""
SELECT label_id, org_id, l.period, count(*) AS client_num, coalesce(round(sum(rights), 2), 0) / max(days) / 100000000 AS avg_rights, coalesce(round(sum(amt), 2), 0) / 10000 AS done_amount,
       coalesce(round(sum(money), 2), 0) / 100000000 AS done_money, coalesce(round(sum(jgx), 2), 0) / 10000 AS net_contribution
FROM lab l LEFT JOIN e USING (fund_account_id, period) LEFT JOIN d USING (fund_account_id, period) LEFT JOIN c USING (fund_account_id, period)
JOIN k ON k.period = l.period JOIN accounts a ON a.fund_account_id = l.fund_account_id JOIN org_{lv} o ON o.branch_id = a.branch_id GROUP BY 1, 2, 3""",
          lambda spark, sf, o: A.label_cohorts(
              table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label_id"), F.col("o_custkey").alias("fund_account_id"), D.month_key("o_orderdate").alias("period")),
              S.client_sett(spark, sf), S.fills(spark, sf), contributions(spark, sf, D.month_key), o, S.calendar(spark, sf)))
