"""Target reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import reports_ledger as L, standins as S
from catalog.registry import query
from catalog.standins import cte, table, with_
from marginbook.functions import dates as D
from marginbook.functions import measures as M
from marginbook.plans import targets as T

CODES = {c: k for k, c in [(("0", "1"), "001"), (("1", "1"), "002"), (("0", "2"), "003"), (("1", "2"), "004"), (("0", "3"), "005"),
                           (("0", "4"), "006"), (("1", "4"), "007"), (("0", "5"), "008"), (("1", "5"), "009"), (("0", "6"), "010"),
                           (("0", "6"), "011"), (("0", "7"), "012")]}
# Size of each indicator's yearly target, as a multiple of a unit's mean yearly order value.
FACTORS = {"001": 0.05, "002": 0.0, "003": 0.004, "004": 0.0, "005": 0.01, "006": 1.0, "007": 0.0, "008": 0.0008, "009": 0.0,
           "010": 0.0000001, "011": 0.0000001, "012": 0.3}
YEARS = tuple(str(y) for y in range(1995, 2001))


def industry(spark, sf):
    month = table(spark, sf, "lineitem").groupBy(D.month_key("l_shipdate").alias("busi_month")).agg(
        M.money_sum("l_extendedprice").alias("p"), M.money_sum("l_quantity").alias("q"))
    fee = F.floor(F.col("p") / 10000) / 100
    return month.select("busi_month", fee.alias("fee"), (fee * 30).alias("rights"), fee.alias("turnover"), (F.floor(F.col("q") / 10) / 100).alias("volume"))


cte("industry", """
SELECT busi_month, fee, fee * 30 AS rights, fee AS turnover, volume FROM (
  SELECT strftime(l_shipdate, '%Y%m') AS busi_month, floor(round(sum(l_extendedprice), 2) / 10000) / 100 AS fee,
         floor(round(sum(l_quantity), 2) / 10) / 100 AS volume FROM lineitem GROUP BY 1)""")


def sales(spark, sf):
    acc = S.accounts(spark, sf).select(F.col("fund_account_id").alias("o_custkey"), "id_no", "client_name")
    return (table(spark, sf, "orders").join(acc, "o_custkey").select(
        F.to_date("o_orderdate").alias("busi_date"), "id_no", "client_name", (F.col("o_custkey") % 3).cast("string").alias("wh_trade_type"),
        F.col("o_totalprice").alias("confirm_share")))


cte("sales", """
SELECT CAST(o_orderdate AS DATE) AS busi_date, id_no, client_name, CAST(o_custkey % 3 AS VARCHAR) AS wh_trade_type, o_totalprice AS confirm_share
FROM orders JOIN accounts ON o_custkey = fund_account_id""", "accounts")


def target_rows(spark, sf):
    """Targets filed by every unit for six years: sized by the mean yearly order value of a unit."""
    base = table(spark, sf, "orders").agg((M.money_sum("o_totalprice") / 175).alias("t"))
    rows = [(y, c, CODES[c][0], CODES[c][1], n, FACTORS[c]) for y in YEARS for c, n in T.INDICATORS]
    spec = spark.createDataFrame(rows, "year_id string, index_id string, index_type string, index_asses_benchmark string, index_name string, f double")
    n = F.col("n_nationkey")
    from marginbook.operators.joins import against_total, scaffold
    df = against_total(scaffold(table(spark, sf, "nation"), spec), base)
    value = F.when(F.col("index_type") == "1", 0.04 + n * 0.001).otherwise(F.floor(F.col("t") * F.col("f") * (1 + (n % 5 - 2) * 0.2)))
    df = df.withColumn("year_target_value", value.cast("double"))
    y = F.col("year_target_value")
    parts = {1: 0.2, 2: 0.3, 3: 0.25, 4: 0.25}
    return df.select(
        "year_id", F.col("n_name").alias("oa_branch_id"), "index_id", "index_type", "index_asses_benchmark", "index_name", "year_target_value",
        *[(y * p).alias(f"quarter_target_{i}") for i, p in parts.items()], F.lit(0.0).alias("target_growth_rate"),
        *[F.lit(p).alias(f"quarter_target_rate_{i}") for i, p in parts.items()],
        F.when(n % 6 == 5, "0").otherwise("1").alias("index_status"), F.lit(0.1).alias("weight_rate"), F.lit(120.0).alias("upper_limit_score"))


cte("targets", f"""
SELECT *, y * 0.2::DOUBLE AS q1, y * 0.3::DOUBLE AS q2, y * 0.25::DOUBLE AS q3, y * 0.25::DOUBLE AS q4 FROM (
  SELECT yr AS year_id, n_name AS oa_branch_id, n_nationkey AS n, i.*,
         CASE WHEN index_type = '1' THEN 0.04::DOUBLE + n_nationkey * 0.001::DOUBLE
              ELSE floor((SELECT round(sum(o_totalprice), 2) / 175 FROM orders) * f * (1 + (n_nationkey % 5 - 2) * 0.2::DOUBLE)) END AS y
  FROM nation, (SELECT unnest({list(YEARS)!r}) AS yr), (SELECT * FROM (VALUES {", ".join(
      f"('{c}', '{CODES[c][0]}', '{CODES[c][1]}', {FACTORS[c]!r}::DOUBLE)" for c in CODES)}) v(code, index_type, bench, f)) i)""")


def sources(spark, sf):
    return T.TargetSources(
        statement=L.statement(spark, sf), book_units=S.books(spark, sf), sett=S.client_sett(spark, sf), trades=S.fills(spark, sf),
        accounts=S.accounts(spark, sf), branch_map=S.branch_map(spark, sf), relations=S.relations(spark, sf), sales=sales(spark, sf),
        industry=industry(spark, sf), calendar=S.calendar(spark, sf))


def _p(grain: str, d: str) -> str:
    return {"month": f"strftime({d}, '%Y%m')", "year": f"strftime({d}, '%Y')",
            "quarter": f"strftime({d}, '%Y') || CAST(quarter({d}) AS VARCHAR)"}[grain]


def _pm(grain: str, m: str) -> str:
    return {"month": m, "year": f"substr({m}, 1, 4)",
            "quarter": f"substr({m}, 1, 4) || CAST((CAST(substr({m}, 5, 2) AS INTEGER) + 2) // 3 AS VARCHAR)"}[grain]


NEEDS = ("statement", "books", "client_sett", "fills", "accounts", "org_unit", "relations", "sales", "industry", "daymap")


def actual_parts(grain: str) -> dict[str, str]:
    def fresh(extra: str) -> str:
        return f"""SELECT {_p(grain, 'a.open_date')} AS period, o.org_id, CAST(count(*) AS DOUBLE) AS v FROM accounts a JOIN org_unit o USING (branch_id)
  JOIN spans s ON s.period = {_p(grain, "a.open_date")}
  WHERE EXISTS (SELECT 1 FROM fills f JOIN daymap d ON d.busi_date = f.busi_date WHERE f.fund_account_id = a.fund_account_id AND f.transfee <> 0 AND {_p(grain, 'f.busi_date')} = s.period)
    AND NOT EXISTS (SELECT 1 FROM relations r WHERE r.fund_account_id = a.fund_account_id AND rela_sts = 'A' AND approve_sts = '0' {extra}
                    AND greatest(st_dt, b) <= least(end_dt, e)) GROUP BY 1, 2"""
    return dict(
        spans=f"SELECT {_p(grain, 'busi_date')} AS period, min(busi_date) AS b, max(busi_date) AS e, CAST(sum(trade_flag) AS BIGINT) AS days FROM daymap GROUP BY 1",
        market=f"""SELECT {_pm(grain, 'busi_month')} AS period, round(sum(fee), 6) * 100000000 AS fee, round(sum(rights), 6) * 100000000 AS rights,
  round(sum(turnover), 6) * 100000000 * 2 AS turnover, round(sum(volume), 6) * 100000000 * 2 AS volume FROM industry GROUP BY 1""",
        li=f"""SELECT {_pm(grain, 'month_id')} AS period, oa_branch_id AS org_id, round(sum(f5), 2) AS f5, round(sum(f6), 2) AS f6, round(sum(f8), 2) AS f8,
  round(sum(f18), 2) AS f18 FROM statement JOIN books USING (book_id) GROUP BY 1, 2""",
        eq=f"""SELECT {_p(grain, 's.busi_date')} AS period, org_id, round(sum(rights), 2) / max(days) AS v, max(days) AS days FROM client_sett s
  JOIN daymap d ON d.busi_date = s.busi_date AND d.trade_flag = 1 JOIN accounts a ON a.fund_account_id = s.fund_account_id
  JOIN org_unit o ON o.branch_id = a.branch_id JOIN spans p ON p.period = {_p(grain, 's.busi_date')} GROUP BY 1, 2""",
        ac=f"""SELECT {_p(grain, 's.busi_date')} AS period, org_id, round(sum(done_sum), 2) AS m, round(sum(done_amt), 2) AS q FROM fills s
  JOIN daymap d ON d.busi_date = s.busi_date AND d.trade_flag = 1 JOIN accounts a ON a.fund_account_id = s.fund_account_id
  JOIN org_unit o ON o.branch_id = a.branch_id GROUP BY 1, 2""",
        so=f"""SELECT {_p(grain, 's.busi_date')} AS period, org_id, round(sum(confirm_share), 2) AS v FROM sales s
  JOIN accounts a ON a.id_no = s.id_no AND a.client_name = s.client_name JOIN org_unit o ON o.branch_id = a.branch_id WHERE wh_trade_type IN ('0', '1') GROUP BY 1, 2""",
        n10=fresh("AND broker_rela_typ = '301'"), n11=fresh(""),
        actuals="""SELECT period, org_id, '001' AS busi_type, f5 AS value, NULL::DOUBLE AS industry FROM li UNION ALL SELECT period, org_id, '005', f18, NULL FROM li
  UNION ALL SELECT l.period, org_id, '002', CASE WHEN fee <> 0 THEN round(f6 + f8, 2) / fee ELSE 0 END, fee FROM li l LEFT JOIN market m ON m.period = l.period
  UNION ALL SELECT period, org_id, '003', v, NULL FROM eq
  UNION ALL SELECT e.period, org_id, '004', CASE WHEN coalesce(rights, 0) / days <> 0 THEN v / (coalesce(rights, 0) / days) ELSE 0 END,
    CASE WHEN days <> 0 THEN coalesce(rights, 0) / days ELSE 0 END FROM eq e LEFT JOIN market m ON m.period = e.period
  UNION ALL SELECT period, org_id, '006', m, NULL FROM ac UNION ALL SELECT period, org_id, '008', q, NULL FROM ac
  UNION ALL SELECT c.period, org_id, '007', CASE WHEN turnover <> 0 THEN m / turnover ELSE 0 END, turnover FROM ac c LEFT JOIN market k ON k.period = c.period
  UNION ALL SELECT c.period, org_id, '009', CASE WHEN volume <> 0 THEN q / volume ELSE 0 END, volume FROM ac c LEFT JOIN market k ON k.period = c.period
  UNION ALL SELECT period, org_id, '010', v, NULL FROM n10 UNION ALL SELECT period, org_id, '011', v, NULL FROM n11 UNION ALL SELECT period, org_id, '012', v, NULL FROM so""")


@query("indicator_actuals_by_quarter", with_(*NEEDS, **actual_parts("quarter")) + "SELECT * FROM actuals")
def indicator_actuals_by_quarter(spark, sf):
    return T.indicator_actuals(sources(spark, sf), "quarter")


NAMES = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in T.INDICATORS) + ") v(code, name)"
CHECK = dict(names=NAMES, lastyear="SELECT CAST(CAST(period AS INTEGER) + 1 AS VARCHAR) AS year_id, org_id AS oa_branch_id, busi_type AS code, value FROM actuals", t1="""
  SELECT t.*, value AS last_year_complet_value, CASE WHEN value <> 0 THEN y / value - 1 ELSE 0 END AS growth_rate,
         max(CASE WHEN index_type = '0' THEN CASE WHEN y <> 0 THEN q1 / y ELSE 0 END END) OVER w AS p1,
         max(CASE WHEN index_type = '0' THEN CASE WHEN y <> 0 THEN q2 / y ELSE 0 END END) OVER w AS p2,
         max(CASE WHEN index_type = '0' THEN CASE WHEN y <> 0 THEN q3 / y ELSE 0 END END) OVER w AS p3,
         max(CASE WHEN index_type = '0' THEN CASE WHEN y <> 0 THEN q4 / y ELSE 0 END END) OVER w AS p4
  FROM targets t LEFT JOIN lastyear USING (year_id, oa_branch_id, code) WINDOW w AS (PARTITION BY year_id, oa_branch_id, bench)""", checked="""
  SELECT year_id, oa_branch_id, code, n, index_type, bench, y AS year_target_value, last_year_complet_value, growth_rate,
         CASE WHEN y <> 0 THEN q1 / y ELSE 0 END AS prop_1, CASE WHEN y <> 0 THEN q2 / y ELSE 0 END AS prop_2,
         CASE WHEN y <> 0 THEN q3 / y ELSE 0 END AS prop_3, CASE WHEN y <> 0 THEN q4 / y ELSE 0 END AS prop_4,
         CASE WHEN index_type = '1' THEN y * p1 * 4 ELSE q1 END AS quarter_target_1, CASE WHEN index_type = '1' THEN y * p2 * 4 ELSE q2 END AS quarter_target_2,
         CASE WHEN index_type = '1' THEN y * p3 * 4 ELSE q3 END AS quarter_target_3, CASE WHEN index_type = '1' THEN y * p4 * 4 ELSE q4 END AS quarter_target_4,
         CASE WHEN index_type = '0' AND round(growth_rate, 6) = 0 AND y <> 0 THEN '1'
              WHEN index_type = '1' AND round(y * p1 * 4 + y * p2 * 4 + y * p3 * 4 + y * p4 * 4, 4) = round(y, 4) THEN '1' ELSE '0' END AS check_result FROM t1""")


def checked_targets(spark, sf, base=None):
    return T.check_annual_targets(target_rows(spark, sf), T.indicator_actuals(sources(spark, sf), "year", base))


@query("annual_target_check", with_(*NEEDS, "targets", **actual_parts("year"), **CHECK) + """
SELECT year_id, oa_branch_id, code AS index_id, code AS busi_type, index_type, bench AS index_asses_benchmark, name AS index_name, year_target_value,
       last_year_complet_value, growth_rate, quarter_target_1, quarter_target_2, quarter_target_3, quarter_target_4, prop_1 AS quarter_target_prop_1,
       prop_2 AS quarter_target_prop_2, prop_3 AS quarter_target_prop_3, prop_4 AS quarter_target_prop_4, 0::DOUBLE AS target_growth_rate,
       0.2::DOUBLE AS quarter_target_rate_1, 0.3::DOUBLE AS quarter_target_rate_2, 0.25::DOUBLE AS quarter_target_rate_3, 0.25::DOUBLE AS quarter_target_rate_4,
       CASE WHEN n % 6 = 5 THEN '0' ELSE '1' END AS index_status, 0.1::DOUBLE AS weight_rate, 120::DOUBLE AS upper_limit_score, check_result FROM checked JOIN names USING (code)""")
def annual_target_check(spark, sf):
    return checked_targets(spark, sf)


@query("target_book", with_(*NEEDS, "targets", **actual_parts("year"), **CHECK) + """
SELECT coalesce(b.year_id, c.year_id) AS year_id, coalesce(b.oa_branch_id, c.oa_branch_id) AS oa_branch_id, coalesce(b.code, c.code) AS index_id,
       coalesce(c.year_target_value, b.y + 1) AS year_target_value, coalesce(c.quarter_target_1, b.q1) AS quarter_target_1, coalesce(c.quarter_target_2, b.q2) AS quarter_target_2,
       coalesce(c.quarter_target_3, b.q3) AS quarter_target_3, coalesce(c.quarter_target_4, b.q4) AS quarter_target_4,
       coalesce(b.index_type, c.index_type) AS index_type, coalesce(b.bench, c.bench) AS index_asses_benchmark, name AS index_name, 0::DOUBLE AS target_growth_rate,
       0.2::DOUBLE AS quarter_target_rate_1, 0.3::DOUBLE AS quarter_target_rate_2, 0.25::DOUBLE AS quarter_target_rate_3, 0.25::DOUBLE AS quarter_target_rate_4,
       CASE WHEN coalesce(b.n, c.n) % 6 = 5 THEN '0' ELSE '1' END AS index_status, 0.1::DOUBLE AS weight_rate, 120::DOUBLE AS upper_limit_score
FROM (SELECT * FROM targets WHERE year_id < '1997') b
FULL JOIN (SELECT * FROM checked WHERE check_result = '1' AND n % 6 <> 5) c ON b.year_id = c.year_id AND b.oa_branch_id = c.oa_branch_id AND b.code = c.code
JOIN names ON names.code = coalesce(b.code, c.code)""")
def target_book(spark, sf):
    book = target_rows(spark, sf).filter("year_id < '1997'").withColumn("year_target_value", F.col("year_target_value") + 1)
    return T.target_book(book, checked_targets(spark, sf))


PASSED = with_(*NEEDS, "targets", **actual_parts("year"), **CHECK) + """
SELECT year_id, oa_branch_id, code FROM checked WHERE check_result = '1' AND n % 6 <> 5"""


@query("target_completion", with_(*NEEDS, "targets", **actual_parts("month"), passed=PASSED, j="""
  SELECT t.*, a.period AS busi_month, CAST((CAST(substr(period, 5, 2) AS INTEGER) + 2) // 3 AS VARCHAR) AS quarter_id, value, industry
  FROM targets t JOIN passed p ON p.year_id = t.year_id AND p.oa_branch_id = t.oa_branch_id AND p.code = t.code
  JOIN actuals a ON a.org_id = t.oa_branch_id AND a.busi_type = t.code AND substr(period, 1, 4) = t.year_id""", k="""
  SELECT *, CASE WHEN index_type = '1' THEN round(avg(value) OVER q, 12) ELSE round(sum(value) OVER q, 4) END AS quarter_value,
         CASE WHEN index_type = '1' THEN round(avg(value) OVER z, 12) ELSE round(sum(value) OVER z, 4) END AS year_value,
         CASE quarter_id WHEN '1' THEN q1 WHEN '2' THEN q2 WHEN '3' THEN q3 ELSE q4 END AS quarter_target
  FROM j WINDOW q AS (PARTITION BY year_id, oa_branch_id, code, quarter_id ORDER BY busi_month), z AS (PARTITION BY year_id, oa_branch_id, code ORDER BY busi_month)""") + """
SELECT year_id, oa_branch_id, code AS index_id, busi_month, value AS index_value_branch, industry AS index_value_indust, quarter_value, year_value,
       CASE WHEN quarter_target <> 0 THEN quarter_value / quarter_target * 100 ELSE 0 END AS quarter_rate,
       CASE WHEN y <> 0 THEN year_value / y * 100 ELSE 0 END AS year_rate FROM k""")
def target_completion(spark, sf):
    keys = ["year_id", "oa_branch_id", "index_id"]
    base = T.stored_base(T.indicator_base(sources(spark, sf)))  # read for the year and for the months
    passed = checked_targets(spark, sf, base).filter("check_result = '1' AND index_status = '1'").select(*keys)
    return T.target_completion(target_rows(spark, sf).join(passed, keys, "left_semi"), T.indicator_actuals(sources(spark, sf), "month", base)).select(
        "year_id", "oa_branch_id", "index_id", "busi_month", "index_value_branch", "index_value_indust", "quarter_value", "year_value", "quarter_rate", "year_rate")


def assessed(spark, sf):
    return T.assessment(target_rows(spark, sf), T.indicator_actuals(sources(spark, sf), "quarter"))


ASSESS = dict(names=NAMES, lng="""
  SELECT t.year_id, q AS quarter_id, t.oa_branch_id, t.code, t.index_type, t.bench, CASE q WHEN '1' THEN q1 WHEN '2' THEN q2 WHEN '3' THEN q3 ELSE q4 END AS target, coalesce(a.value, 0) AS actual
  FROM targets t CROSS JOIN (SELECT unnest(['1', '2', '3', '4']) AS q) LEFT JOIN actuals a ON a.period = t.year_id || q AND a.org_id = t.oa_branch_id AND a.busi_type = t.code""", sur="""
  SELECT year_id, oa_branch_id, code, round(sum(CASE WHEN quarter_id = '1' AND actual > target THEN actual - target ELSE 0 END), 6) AS s1,
         round(sum(CASE WHEN quarter_id = '2' AND actual > target THEN actual - target ELSE 0 END), 6) AS s2,
         round(sum(CASE WHEN quarter_id = '3' AND actual > target THEN actual - target ELSE 0 END), 6) AS s3 FROM lng GROUP BY 1, 2, 3""", took="""
  SELECT l.*, CASE WHEN actual <= target AND quarter_id > '1' THEN s1 ELSE 0 END AS adjust_1, CASE WHEN actual <= target AND quarter_id > '2' THEN s2 ELSE 0 END AS adjust_2,
         CASE WHEN actual <= target AND quarter_id > '3' THEN s3 ELSE 0 END AS adjust_3 FROM lng l JOIN sur USING (year_id, oa_branch_id, code)""", scored="""
  SELECT *, actual + adjust_1 + adjust_2 + adjust_3 AS completed, CASE WHEN target <> 0 THEN (actual + adjust_1 + adjust_2 + adjust_3) / target ELSE 0 END AS rate FROM took""")


@query("target_assessment", with_(*NEEDS, "targets", **actual_parts("quarter"), **ASSESS) + """
SELECT year_id, quarter_id, oa_branch_id, code AS index_id, code AS busi_type, index_type, bench AS index_asses_benchmark, name AS index_name,
       target AS target_value, actual AS actual_value, adjust_1, adjust_2, adjust_3, 0.1::DOUBLE AS weight_rate, 120::DOUBLE AS upper_limit_score,
       CASE WHEN adjust_1 > 0 THEN '1季度' ELSE '-' END AS adjust_quarter_1, CASE WHEN adjust_2 > 0 THEN '2季度' ELSE '-' END AS adjust_quarter_2,
       CASE WHEN adjust_3 > 0 THEN '3季度' ELSE '-' END AS adjust_quarter_3, completed, rate AS complet_achievement_rate,
       CASE WHEN rate > 120.0::DOUBLE / 100 THEN 0.1::DOUBLE * 120 WHEN rate > 0 THEN rate * 0.1::DOUBLE * 100 ELSE 0 END AS get_score FROM scored JOIN names USING (code)""")
def target_assessment(spark, sf):
    return assessed(spark, sf)


def _completion(level: str, grain: str):
    dates = ["year_id"] + (["quarter_id"] if grain == "quarter" else [])
    d = ", ".join(dates)

    def run(spark, sf):
        periods = S.calendar(spark, sf).select(D.year_key("busi_date").alias("year_id"), D.quarter_of("busi_date").alias("quarter_id")).select(*dates).distinct()
        return T.completion_by_indicator(assessed(spark, sf), S.units(spark, sf), periods, level, grain)
    orgs = {"unit": "SELECT departmentid AS oa_branch_id, departmentid AS org_id FROM units WHERE canceled IS NULL",
            "line": "SELECT departmentid AS oa_branch_id, business_line_id AS org_id FROM units WHERE business_line_id IS NOT NULL",
            "respons": "SELECT departmentid AS oa_branch_id, respons_line_id AS org_id FROM units WHERE respons_line_id IS NOT NULL"}[level]
    names = ", ".join(f"('{c}', '{n}')" for c, n in T.INDICATORS)
    sql = with_(*NEEDS, "targets", "units", **actual_parts("quarter"), **ASSESS, members=orgs, done=f"""
  SELECT {d}, org_id, code AS busi_type, CASE WHEN code IN ('002', '004', '007', '009') THEN round(sum(target), 12) ELSE round(sum(target), 4) END AS t,
         CASE WHEN code IN ('002', '004', '007', '009') THEN round(sum(completed), 12) ELSE round(sum(completed), 4) END AS v FROM scored JOIN members USING (oa_branch_id) GROUP BY {d}, org_id, code""",
                periods=f"SELECT DISTINCT {d} FROM (SELECT strftime(busi_date, '%Y') AS year_id, CAST(quarter(busi_date) AS VARCHAR) AS quarter_id FROM daymap)") + f"""
SELECT {d}, org_id, busi_type, busi_type_name, v AS complete_value, CASE WHEN t IS NULL THEN NULL WHEN t <> 0 THEN v / t * 100 ELSE 0 END AS complete_value_rate
FROM periods CROSS JOIN (SELECT DISTINCT org_id FROM members) CROSS JOIN (VALUES {names}) v(busi_type, busi_type_name) LEFT JOIN done USING ({d}, org_id, busi_type)"""
    query(f"target_completion_by_{level}_and_{grain}", sql)(run)


for _lv in ("unit", "line", "respons"):
    for _g in ("quarter", "year"):
        _completion(_lv, _g)
