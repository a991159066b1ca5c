"""General-ledger reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import standins as S
from catalog.registry import query
from catalog.standins import cte, scratch, table, with_
from marginbook.functions import dates as D
from marginbook.plans import ledger
from marginbook.sources import partitions

CODES = ("6021", "6421", "642102", "6011", "6411", "6111", "6101", "6061", "6051", "6601", "6404", "6701", "6402",
         "6301", "630101", "6711", "671101", "660143", "6403", "6801")
GROUPS = (ledger.REVENUE, ledger.COST, ledger.PROFIT, *ledger.MOVED_OUT, *ledger.MOVED_IN)
# The configuration table of indicators: every group with every code; costs count negative.
INDICATORS = [(g, c, f"{g}/{c}", -1.0 if g.startswith(ledger.COST) else 1.0) for g in GROUPS for c in CODES]


def indicators(spark):
    return spark.createDataFrame(INDICATORS, "index_para_name string, index_id string, index_name string, cal_direction double")


cte("indicators", f"""
SELECT g AS index_para_name, c AS index_id, g || '/' || c AS index_name,
       CASE WHEN g LIKE '{ledger.COST}%' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS cal_direction
FROM (SELECT unnest({list(GROUPS)!r}) AS g), (SELECT unnest({list(CODES)!r}) AS c)""")
cte("results", f"""
SELECT busi_month, book_id, index_para_name, index_id, index_name, round(sum(amount), 2) * cal_direction AS index_value FROM (
  SELECT account_period AS busi_month, book_code AS book_id, i.*, local_credit_sum AS amount FROM ledger JOIN indicators i
    ON starts_with(account_code, index_id)
   AND (CASE WHEN index_para_name LIKE '%调出金额' THEN summary LIKE '%调减%' WHEN index_para_name LIKE '%调入金额' THEN summary LIKE '%调增%' ELSE TRUE END)
  WHERE book_code NOT IN (SELECT book_code FROM excluded_books)) GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY busi_month, book_id, index_para_name, index_id, index_name, cal_direction"),
    "ledger", "indicators", "excluded_books")


def _line(p: str, n: int, groups, codes) -> str:
    g, c = ", ".join(f"'{x}'" for x in groups), ", ".join(f"'{x}'" for x in codes)
    return f"round(coalesce(sum(CASE WHEN index_para_name IN ({g}) AND index_id IN ({c}) THEN index_value END), 0), 2) AS {p}{n}"


_BOOK = ", ".join([_line("b", n, (g,), ids) for n, (g, ids) in ledger.OWN_LINES.items()]
                  + [_line(p, n, gs, ids) for p, gs in (("c", ledger.MOVED_OUT), ("d", ledger.MOVED_IN)) for n, ids in ledger.MOVED_LINES.items()])
_HAVE = [f"b{n}" for n in ledger.OWN_LINES] + [f"{p}{n}" for p in "cd" for n in ledger.MOVED_LINES]


def _totals_sql(p: str) -> str:
    five, twelve = "+".join(f"{p}{i}" for i in range(6, 12)), "+".join(f"{p}{i}" for i in range(13, 18))
    return (f"round({five}, 2) AS {p}5, round({twelve}, 2) AS {p}12, round({p}5 - {p}12, 2) AS {p}18, "
            f"round({p}18 + {p}19 - {p}20, 2) AS {p}21, round({p}21 - {p}22, 2) AS {p}23")


cte("book_months", "SELECT DISTINCT account_period AS month_id FROM ledger", "ledger")
cte("statement_lines", f"""
SELECT *, {_totals_sql('b')}, {_totals_sql('c')}, {_totals_sql('d')} FROM (
  SELECT m.month_id, k.book_id, {", ".join(f"coalesce(r.{c}, 0) AS {c}" for c in _HAVE)}, 0.0::DOUBLE AS b13,
         CAST(round(CAST(coalesce(r.b6, 0) AS DECIMAL(18, 2)) * 0.0072, 2) AS DOUBLE) AS b14, coalesce(t.v, 0) AS b22
  FROM books k CROSS JOIN book_months m
  LEFT JOIN (SELECT busi_month, book_id, {_BOOK} FROM results GROUP BY 1, 2) r ON r.busi_month = m.month_id AND r.book_id = k.book_id
  LEFT JOIN (SELECT account_period, book_code, round(sum(local_credit_sum), 2) AS v FROM ledger WHERE account_code LIKE '6801%'
             AND book_code NOT IN (SELECT book_code FROM excluded_books) GROUP BY 1, 2) t ON t.account_period = m.month_id AND t.book_code = k.book_id)""",
    "books", "book_months", "results", "excluded_books")
_L = range(5, 24)
cte("statement", "SELECT *, " + ", ".join(
    f"round(sum(f{i}) OVER (PARTITION BY book_id, substr(month_id, 1, 4) ORDER BY month_id), 2) AS g{i}" for i in _L)
    + " FROM (SELECT *, " + ", ".join(f"round(c{i} + d{i}, 2) AS e{i}, round(b{i} + c{i} + d{i}, 2) AS f{i}" for i in _L)
    + " FROM statement_lines)", "statement_lines")


def results(spark, sf):
    return ledger.indicator_results(S.ledger(spark, sf), indicators(spark), S.excluded_books(spark, sf))


def book_months(spark, sf):
    return table(spark, sf, "lineitem").select(D.month_key("l_shipdate").alias("month_id")).distinct()


def statement(spark, sf):
    return ledger.profit_statement(results(spark, sf), S.ledger(spark, sf), S.excluded_books(spark, sf),
                                   S.books(spark, sf), book_months(spark, sf))


@query("ledger_account_activity", with_("ledger", "excluded_books") + """
SELECT account_period, book_code AS book_id, round(sum(local_credit_sum), 2) * -1 AS index_value FROM ledger
WHERE account_code LIKE '60%' AND summary LIKE '%调减%' AND book_code NOT IN (SELECT book_code FROM excluded_books) GROUP BY 1, 2""")
def ledger_account_activity(spark, sf):
    return ledger.account_activity(S.ledger(spark, sf), S.excluded_books(spark, sf), "60", -1, ledger.OUT_WORD)


query("ledger_indicator_results", with_("results") + "SELECT * FROM results")(results)
@query("rolling_rebuild", with_("results") + "SELECT * FROM results")
def rolling_rebuild(spark, sf):
    """Results built when the last four months were not final, and rebuilt for these months only when they were."""
    final, excluded = S.ledger(spark, sf), S.excluded_books(spark, sf)
    last = final.agg(F.max("account_period")).first()[0]
    open_months = F.col("account_period").isin(partitions.months_back(last))
    # Later vouchers change amounts, and book to accounts that had none.
    early = (final.filter(~open_months | (F.col("account_code") < "66")).withColumn(
        "local_credit_sum", F.when(open_months, F.col("local_credit_sum") * 3).otherwise(F.col("local_credit_sum"))))
    first = ledger.indicator_results(early, indicators(spark), excluded)
    schema = T.StructType([*[f for f in first.schema.fields if f.name != "busi_month"], first.schema["busi_month"]])
    name = f"results_{uuid.uuid4().hex}"
    partitions.create_table(spark, name, schema, ["busi_month"], scratch(spark))
    partitions.append_rows(first, name)

    def build(months):
        return ledger.indicator_results(final.filter(F.col("account_period").isin(months)), indicators(spark), excluded)

    partitions.rebuild_months(spark, build, name, last)
    return spark.table(name).select(*first.columns)


query("profit_statement", with_("statement") + "SELECT month_id, book_id, "
      + ", ".join(f"{p}{i}" for p in "bcdefg" for i in _L) + " FROM statement")(statement)


@query("levy_adjustment_rows", with_(kept="""
  SELECT strftime(o_orderdate, '%Y%m') AS busi_month, CAST(o_custkey % 25 AS INTEGER) AS branch_id, round(sum(o_totalprice), 2) AS adjust_value
  FROM orders GROUP BY 1, 2""", mon="SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS busi_month FROM orders") + """
SELECT m.busi_month, n_nationkey AS branch_id, k.adjust_value FROM nation CROSS JOIN mon m
LEFT JOIN kept k ON k.busi_month = m.busi_month AND k.branch_id = n_nationkey""")
def levy_adjustment_rows(spark, sf):
    orders = table(spark, sf, "orders")
    month = D.month_key("o_orderdate").alias("busi_month")
    kept = orders.groupBy(month, (F.col("o_custkey") % 25).cast("int").alias("branch_id")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("adjust_value"))
    return ledger.levy_adjustment_rows(kept, table(spark, sf, "nation").select(F.col("n_nationkey").alias("branch_id")),
                                       orders.select(month).distinct())


@query("resident_staff", with_("relations", known="""
  SELECT 'ZD' || CAST(s_suppkey % 40 AS VARCHAR) AS broker_id, min(s_name) AS broker_name FROM supplier WHERE s_suppkey % 40 < 8 GROUP BY 1""") + """
SELECT * FROM known UNION ALL SELECT DISTINCT broker_id, NULL FROM relations
WHERE broker_id LIKE 'ZD%' AND broker_id NOT IN (SELECT broker_id FROM known)""")
def resident_staff(spark, sf):
    k = F.col("s_suppkey") % 40
    known = table(spark, sf, "supplier").filter(k < 8).groupBy(F.concat(F.lit("ZD"), k.cast("string")).alias("broker_id")).agg(
        F.min("s_name").alias("broker_name"))
    return ledger.resident_staff(known, S.relations(spark, sf).select("broker_id").distinct())
