"""One query per operator of the library, over whole tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import query
from catalog.standins import scratch, table, with_
from marginbook.functions import codes, dates as D, measures as M
from marginbook.operators import balances, calendar as C, distinct, joins as J, merge, orgs, ranking as R, running, spine, strings
from marginbook.sources import buckets, partitions, schemas, sink, tables

# ---- sources and sinks ----------------------------------------------------------------------


@query("table_scan", """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' GROUP BY 1""")
def table_scan(spark, sf):
    df = tables.read_table(spark, f"{sf}/orders.parquet", ["o_orderstatus", "o_totalprice", "o_orderdate"])
    return (df.filter(tables.day_range("o_orderdate", date(1996, 1, 1), date(2000, 12, 31)))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), M.money_sum("o_totalprice").alias("total")))


@query("schema_aligned_load", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS busi_year, CAST(quarter(o_orderdate) AS VARCHAR) AS busi_quarter,
       o_orderstatus AS status, round(sum(o_totalprice), 2) AS total, CAST(NULL AS VARCHAR) AS note
FROM orders GROUP BY 1, 2, 3""")
def schema_aligned_load(spark, sf):
    target = schemas.text_and_double("status total note busi_year busi_quarter", doubles="total")
    totals = table(spark, sf, "orders").groupBy(
        D.year_key("o_orderdate").alias("BUSI_YEAR"),
        D.quarter_of("o_orderdate").alias("BUSI_QUARTER"), F.col("o_orderstatus").alias("STATUS")
    ).agg(M.money_sum("o_totalprice").alias("TOTAL"), F.lit("unused").alias("SURPLUS_COLUMN"))
    path = scratch(spark)
    sink.load_aligned(totals, target, path, "overwrite", ["busi_year", "busi_quarter"])
    return spark.read.schema(target).parquet(path).select("busi_year", "busi_quarter", "status", "total", "note")


_QUARTERS = """
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS busi_year, CAST(quarter(o_orderdate) AS VARCHAR) AS busi_quarter, o_orderstatus AS status,
         round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3"""


def _quarter_table(spark, sf):
    """An empty catalog table, and the totals of all orders to load into it."""
    target = schemas.text_and_double("status total note busi_year busi_quarter", doubles="total")
    name, path = f"quarters_{uuid.uuid4().hex}", scratch(spark)
    partitions.create_table(spark, name, target, ["busi_year", "busi_quarter"], path)
    totals = table(spark, sf, "orders").groupBy(
        D.year_key("o_orderdate").alias("BUSI_YEAR"), D.quarter_of("o_orderdate").alias("BUSI_QUARTER"),
        F.col("o_orderstatus").alias("STATUS")).agg(M.money_sum("o_totalprice").alias("TOTAL"))
    return name, totals


@query("append_load", with_(q=_QUARTERS) + """
SELECT busi_year, busi_quarter, CAST(count(*) AS BIGINT) AS rows, round(sum(total), 2) AS total, CAST(count(NULLIF(status, 'F')) AS BIGINT) AS later FROM q GROUP BY 1, 2""")
def append_load(spark, sf):
    """Two loads into the same partitions: the second adds to the first."""
    name, totals = _quarter_table(spark, sf)
    partitions.append_rows(totals.filter("STATUS = 'F'"), name)
    partitions.append_rows(totals.filter("STATUS <> 'F'"), name)
    return spark.table(name).groupBy("busi_year", "busi_quarter").agg(
        F.count(F.lit(1)).alias("rows"), M.money_sum("total").alias("total"), F.count_if(F.col("status") != "F").alias("later"))


@query("partition_overwrite", with_(q=_QUARTERS) + """
SELECT busi_year, busi_quarter, status, CASE WHEN busi_quarter IN ('2', '4') THEN total ELSE total * 2 END AS total,
       CASE WHEN busi_quarter IN ('2', '4') THEN 'second' ELSE 'first' END AS note FROM q""")
def partition_overwrite(spark, sf):
    """A second load replaces the partitions it has rows for and leaves the others."""
    name, totals = _quarter_table(spark, sf)
    partitions.append_rows(totals.withColumns({"TOTAL": F.col("TOTAL") * 2, "note": F.lit("first")}), name)
    partitions.replace_partitions(totals.filter("BUSI_QUARTER IN ('2', '4')").withColumn("note", F.lit("second")), name)
    return spark.table(name).select("busi_year", "busi_quarter", "status", "total", "note")


@query("partition_purge", with_(q=_QUARTERS, last="SELECT max(busi_year) AS y FROM q") + """
SELECT busi_year, busi_quarter, status, CASE WHEN busi_year = y THEN total / 2 ELSE total END AS total FROM q, last
WHERE NOT (busi_year = y AND busi_quarter <> '1') AND busi_year <> CAST(CAST(y AS INTEGER) - 1 AS VARCHAR)""")
def partition_purge(spark, sf):
    """The last two years are dropped, by part of the key; then one quarter of the last year is loaded again."""
    name, totals = _quarter_table(spark, sf)
    partitions.append_rows(totals, name)
    last = spark.table(name).agg(F.max("busi_year")).first()[0]
    for year in (last, str(int(last) - 1)):
        partitions.purge(spark, name, {"busi_year": year})
    partitions.append_rows(totals.filter((F.col("BUSI_YEAR") == last) & (F.col("BUSI_QUARTER") == "1")).withColumn("TOTAL", F.col("TOTAL") / 2), name)
    return spark.table(name).select("busi_year", "busi_quarter", "status", "total")


@query("load_row_counts", with_(q=_QUARTERS) + """
SELECT mode, partition, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT 'append' AS mode, CAST(NULL AS VARCHAR) AS partition, 1 AS n FROM q
  UNION ALL SELECT 'overwrite', 'busi_year=' || busi_year || '/busi_quarter=' || busi_quarter, 1 FROM q WHERE status = 'O') GROUP BY 1, 2""")
def load_row_counts(spark, sf):
    """What each load reports of itself: rows counted while they were written."""
    name, totals = _quarter_table(spark, sf)
    appended = partitions.append_rows(totals, name)
    return appended.unionByName(partitions.replace_partitions(totals.filter("STATUS = 'O'"), name)).select("mode", "partition", "rows")


# ---- calendar -------------------------------------------------------------------------------

@query("period_bounds", with_("daymap") + """
SELECT min(CASE WHEN trade_flag = 1 THEN busi_date END)::VARCHAR AS begin_date,
       max(CASE WHEN trade_flag = 1 THEN busi_date END)::VARCHAR AS end_date,
       CAST(sum(trade_flag) AS BIGINT) AS days,
       (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN DATE '1997-03-01' AND DATE '1998-06-30') AS orders
FROM daymap WHERE busi_date BETWEEN DATE '1997-03-01' AND DATE '1998-06-30'""")
def period_bounds(spark, sf):
    bounds = C.period_bounds(S.calendar(spark, sf), begin_month="199703", end_month="199806")
    seen = table(spark, sf, "orders").filter(
        F.col("o_orderdate").between(F.lit(date(1997, 3, 1)), F.lit(date(1998, 6, 30)))).agg(
        F.count(F.lit(1)).alias("orders"))
    return J.against_total(bounds.select(F.col("begin_date").cast("string"), F.col("end_date").cast("string"), "days"), seen)


@query("month_day_counts", with_("client_sett", "months", "daymap") + """
SELECT m.month, first_trade::VARCHAR AS first_trade, last_trade::VARCHAR AS last_trade, trade_days, natural_days,
       count(s.fund_account_id) AS settlements, round(coalesce(sum(s.rights), 0), 2) AS rights
FROM months m JOIN daymap d USING (month) LEFT JOIN client_sett s USING (busi_date) GROUP BY ALL""")
def month_day_counts(spark, sf):
    cal = C.period_calendar(S.calendar(spark, sf), "month")
    per_day = S.client_sett(spark, sf).groupBy("busi_date").agg(
        F.count(F.lit(1)).alias("n"), M.money_sum("rights").alias("rights"))
    return (cal.join(per_day, "busi_date", "left")
            .groupBy(F.col("period").alias("month"), F.col("first_trade").cast("string").alias("first_trade"),
                     F.col("last_trade").cast("string").alias("last_trade"), "trade_days", "natural_days")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("settlements"), M.money_sum("rights").alias("rights")))


@query("effective_trading_day", with_("daymap") + """
SELECT strftime(trade_date, '%Y%m%d') AS trade_date, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN daymap ON CAST(o_orderdate AS DATE) = busi_date GROUP BY 1""")
def effective_trading_day(spark, sf):
    days = C.trading_day_map(S.calendar(spark, sf)).select("busi_date", "trade_date")
    per_day = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("busi_date")).agg(
        F.count(F.lit(1)).alias("orders"), M.money_sum("o_totalprice").alias("total"))
    return (per_day.join(days, "busi_date").groupBy(D.day_key("trade_date").alias("trade_date"))
            .agg(F.sum("orders").alias("orders"), M.money_sum("total").alias("total")))


@query("nth_trading_day", with_("daymap", numbered="""
  SELECT *, sum(trade_flag) OVER (ORDER BY busi_date) AS n FROM daymap""", trading="""
  SELECT n, busi_date AS day FROM numbered WHERE trade_flag = 1""") + """
SELECT strftime(f.day, '%Y%m%d') AS settle_day, strftime(b.day, '%Y%m%d') AS notice_day,
       count(*) AS items, round(sum(l_extendedprice), 2) AS total
FROM lineitem JOIN numbered x ON CAST(l_shipdate AS DATE) = x.busi_date
LEFT JOIN trading f ON f.n = x.n + 3 LEFT JOIN trading b ON b.n = x.n - 2 AND x.n > 0
GROUP BY 1, 2""")
def nth_trading_day(spark, sf):
    cal = S.calendar(spark, sf)
    ahead = C.trading_day_map(cal, 3).select("busi_date", F.col("trade_date").alias("ahead"))
    back = C.trading_day_map(cal, -2).select("busi_date", F.col("trade_date").alias("back"))
    per_day = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("busi_date")).agg(
        F.count(F.lit(1)).alias("items"), M.money_sum("l_extendedprice").alias("total"))
    return (per_day.join(ahead, "busi_date").join(back, "busi_date")
            .groupBy(D.day_key("ahead").alias("settle_day"), D.day_key("back").alias("notice_day"))
            .agg(F.sum("items").alias("items"), M.money_sum("total").alias("total")))


@query("natural_day_expansion", with_("client_sett", "daymap", per_day="""
  SELECT busi_date, branch_id, sum(rights) AS rights, sum(margin) AS margin, sum(fund_in) AS fund_in,
         sum(transfee) AS transfee FROM client_sett GROUP BY 1, 2""") + """
SELECT strftime(d.busi_date, '%Y%m%d') AS n_busi_date, branch_id, d.trade_flag, round(rights, 2) AS rights,
       round(margin, 2) AS margin, round(fund_in * d.trade_flag, 2) AS fund_in,
       round(transfee * d.trade_flag, 2) AS transfee
FROM per_day p JOIN daymap d ON p.busi_date = d.trade_date""")
def natural_day_expansion(spark, sf):
    per_day = S.client_sett(spark, sf).groupBy("busi_date", "branch_id").agg(
        *M.sums(["rights", "margin", "fund_in", "transfee"]))
    out = C.expand_natural_days(per_day, S.calendar(spark, sf), ["fund_in", "transfee"], ["rights", "margin"],
                                ["branch_id"])
    return out.select(D.day_key("n_busi_date").alias("n_busi_date"), "branch_id", "trade_flag",
                      "rights", "margin", "fund_in", "transfee")


@query("natural_day_weights", with_("client_sett", "daymap", "months") + """
SELECT d.month, fund_account_id % 10 AS bucket, round(sum(rights), 2) AS carried,
       round(sum(rights), 2) / max(natural_days) AS avg_natural
FROM client_sett s JOIN daymap d ON s.busi_date = d.trade_date JOIN months m ON m.month = d.month
GROUP BY 1, 2""")
def natural_day_weights(spark, sf):
    weights = C.natural_weights(S.calendar(spark, sf), "month")
    per_day = S.client_sett(spark, sf).groupBy((F.col("fund_account_id") % 10).alias("bucket"),
                                               F.col("busi_date").alias("trade_date")).agg(M.money_sum("rights").alias("rights"))
    return (per_day.join(weights, "trade_date").groupBy(F.col("period").alias("month"), "bucket")
            .agg(M.money_sum(F.col("rights") * F.col("carried_days")).alias("carried"), F.max("natural_days").alias("d"))
            .select("month", "bucket", "carried", M.safe_ratio("carried", "d").alias("avg_natural")))


@query("week_totals", """
SELECT CAST(week(o_orderdate) AS INTEGER) AS iso_week, strftime(date_trunc('week', o_orderdate), '%Y%m%d') AS monday,
       strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y%m%d') AS sunday,
       count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3""")
def week_totals(spark, sf):
    monday, sunday = D.week_bounds("o_orderdate")
    return table(spark, sf, "orders").groupBy(
        D.iso_week("o_orderdate").alias("iso_week"), D.day_key(monday).alias("monday"), D.day_key(sunday).alias("sunday")
    ).agg(F.count(F.lit(1)).alias("orders"), M.money_sum("o_totalprice").alias("total"))


@query("quarter_totals", """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS busi_year, CAST(quarter(l_shipdate) AS VARCHAR) AS busi_quarter,
       count(*) AS items, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2""")
def quarter_totals(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        D.year_key("l_shipdate").alias("busi_year"), D.quarter_of("l_shipdate").alias("busi_quarter")
    ).agg(F.count(F.lit(1)).alias("items"), M.money_sum("l_extendedprice").alias("total"))


@query("same_day_last_year", with_(per_day="""
  SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""") + """
SELECT strftime(a.d, '%Y%m%d') AS busi_date, strftime(CAST(a.d - INTERVAL 1 YEAR AS DATE), '%Y%m%d') AS last_date,
       a.total, b.total AS last_total, CASE WHEN b.total <> 0 THEN (a.total / b.total - 1) * 100 ELSE 0 END AS yoy
FROM per_day a LEFT JOIN per_day b ON b.d = CAST(a.d - INTERVAL 1 YEAR AS DATE)""")
def same_day_last_year(spark, sf):
    per_day = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        M.money_sum("o_totalprice").alias("total"))
    last = per_day.select(F.col("d").alias("last_d"), F.col("total").alias("last_total"))
    return (per_day.withColumn("last_d", D.prev_year("d")).join(last, "last_d", "left")
            .select(D.day_key("d").alias("busi_date"), D.day_key("last_d").alias("last_date"), "total", "last_total",
                    M.growth("total", "last_total").alias("yoy")))


@query("month_shift", with_(per_month="""
  SELECT strftime(o_orderdate, '%Y%m') AS m, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""") + """
SELECT a.m AS busi_month, b.m AS from_month, a.total, coalesce(b.total, 0) AS total_3_months_ago
FROM per_month a LEFT JOIN per_month b
  ON b.m = strftime(strptime(a.m || '01', '%Y%m%d') - INTERVAL 3 MONTH, '%Y%m')""")
def month_shift(spark, sf):
    per_month = table(spark, sf, "orders").groupBy(D.month_key("o_orderdate").alias("busi_month")).agg(
        M.money_sum("o_totalprice").alias("total"))
    earlier = per_month.select(D.shift_month("busi_month", 3).alias("busi_month"),
                               F.col("busi_month").alias("from_month"), F.col("total").alias("total_3_months_ago"))
    return (per_month.join(earlier, "busi_month", "left")
            .select("busi_month", "from_month", "total", M.nz("total_3_months_ago").alias("total_3_months_ago")))


@query("date_list", """
SELECT strftime(d, '%Y%m%d') AS busi_date, count(o_orderkey) AS orders
FROM (SELECT CAST(unnest(generate_series((SELECT CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders),
      (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY 1""")
def date_list(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("busi_date")).agg(
        F.count(F.lit(1)).alias("orders"))
    days = orders.agg(F.explode(F.sequence(F.min("busi_date"), F.max("busi_date"))).alias("busi_date"))
    return (days.join(orders, "busi_date", "left")
            .select(D.day_key("busi_date").alias("busi_date"), M.nz("orders").alias("orders")))


@query("previous_month_day", """
SELECT strftime(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE), '%Y%m%d') AS prev_day,
       strftime(last_day(o_orderdate), '%Y%m%d') AS month_end, count(*) AS orders FROM orders GROUP BY 1, 2""")
def previous_month_day(spark, sf):
    return table(spark, sf, "orders").groupBy(
        D.day_key(D.prev_month_day("o_orderdate")).alias("prev_day"),
        D.day_key(D.month_end("o_orderdate")).alias("month_end")).agg(F.count(F.lit(1)).alias("orders"))


# ---- projections, filters, scalar functions ---------------------------------------------------

@query("projection_and_cast", """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name, CAST(c_acctbal AS INTEGER) IS NOT NULL AS has_balance,
       'CNY' AS currency, c_acctbal * 2 + 1 AS doubled FROM customer""")
def projection_and_cast(spark, sf):
    return (table(spark, sf, "customer").withColumnRenamed("c_name", "client_name").drop("c_nationkey")
            .select(F.col("c_custkey").cast("string").alias("client_id"), "client_name",
                    F.col("c_acctbal").cast("int").isNotNull().alias("has_balance"),
                    F.lit("CNY").alias("currency"), F.expr("c_acctbal * 2 + 1").alias("doubled")))


@query("row_filters", """
SELECT l_returnflag, count(*) AS items, round(sum(l_extendedprice), 2) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_quantity BETWEEN 5 AND 40 AND l_returnflag IN ('A', 'N') AND l_shipdate IS NOT NULL
  AND NOT p_brand IN ('Brand#1', 'Brand#2') AND p_type LIKE 'S%' AND p_name LIKE '%ring%' GROUP BY 1""")
def row_filters(spark, sf):
    item = table(spark, sf, "lineitem").filter(
        F.col("l_quantity").between(5, 40) & F.col("l_returnflag").isin("A", "N") & F.col("l_shipdate").isNotNull())
    part = table(spark, sf, "part").filter(
        ~F.col("p_brand").isin("Brand#1", "Brand#2") & F.col("p_type").startswith("S") & F.col("p_name").contains("ring"))
    # Few parts pass: a semi-join on the part key keeps the items' columns narrow.
    return (item.join(part, F.col("l_partkey") == F.col("p_partkey"), "left_semi").groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("items"), M.money_sum("l_extendedprice").alias("total")))


@query("code_labels", with_("relations") + """
SELECT CASE broker_rela_typ WHEN '301' THEN '居间关系' WHEN '001' THEN '开发关系' WHEN '002' THEN '服务关系'
            WHEN '003' THEN '维护关系' ELSE '-' END AS relation,
       CASE rela_sts WHEN 'A' THEN '有效' WHEN 'S' THEN '停止使用' ELSE '-' END AS status,
       CASE approve_sts WHEN '0' THEN '审核通过' WHEN '1' THEN '审核不通过' WHEN '2' THEN '等待审核' ELSE '-' END AS approval,
       count(*) AS relations FROM relations GROUP BY 1, 2, 3""")
def code_labels(spark, sf):
    return S.relations(spark, sf).groupBy(
        codes.label_map("broker_rela_typ", codes.RELATION_LABELS).alias("relation"),
        codes.label_map("rela_sts", codes.RELATION_STATUS).alias("status"),
        codes.label_map("approve_sts", codes.APPROVAL_STATUS).alias("approval")
    ).agg(F.count(F.lit(1)).alias("relations"))


@query("safe_ratios", with_("client_sett", per_account="""
  SELECT fund_account_id, round(sum(rights), 2) AS rights, round(sum(margin), 2) AS margin,
         round(sum(impawn_money), 2) AS impawn FROM client_sett GROUP BY 1""") + """
SELECT fund_account_id, round(rights / 10000, 6) AS rights_wan, CASE WHEN rights <> 0 THEN margin / rights ELSE 0 END AS risk,
       CASE WHEN impawn <> 0 THEN margin / impawn * 100 ELSE 0 END AS cover FROM per_account""")
def safe_ratios(spark, sf):
    per = S.client_sett(spark, sf).groupBy("fund_account_id").agg(*M.sums(["rights", "margin", "impawn_money"]))
    return per.select("fund_account_id", F.round(F.col("rights") / 10000, 6).alias("rights_wan"),
                      M.safe_ratio("margin", "rights").alias("risk"),
                      M.share_pct("margin", "impawn_money").alias("cover"))


@query("null_defaults", with_("relations", "securities") + """
SELECT 'relation' AS kind, CAST(count(*) AS BIGINT) AS n, round(sum(coalesce(data_pct, 1)), 4) AS total FROM relations
UNION ALL SELECT 'contract', count(*), CAST(sum(CAST(coalesce(delivery_year, '0') AS INTEGER)) AS DOUBLE) FROM securities""")
def null_defaults(spark, sf):
    rel = S.relations(spark, sf).select(F.lit("relation").alias("kind"), F.coalesce("data_pct", F.lit(1)).alias("v"))
    con = S.securities(spark, sf).fillna("0").select(F.lit("contract").alias("kind"), F.col("delivery_year").cast("double").alias("v"))
    return rel.unionByName(con).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query("text_functions", with_("securities", "accounts") + """
SELECT security_id AS id, regexp_replace(product_name || '-' || market_id, '-', '', 'g') AS plain,
       regexp_extract(contract_code, '[0-9]+', 0) AS digits, right(contract_code, 3) AS tail,
       length(product_name) AS size, trim('  ' || product_id || ' ') AS trimmed,
       concat_ws('/', market_id, delivery_year, product_id) AS path FROM securities""")
def text_functions(spark, sf):
    return S.securities(spark, sf).select(
        F.col("security_id").alias("id"), codes.undash(F.concat("product_name", F.lit("-"), "market_id")).alias("plain"),
        F.regexp_extract("contract_code", "[0-9]+", 0).alias("digits"), F.substring("contract_code", -3, 3).alias("tail"),
        F.length("product_name").cast("long").alias("size"),
        F.trim(F.concat(F.lit("  "), "product_id", F.lit(" "))).alias("trimmed"),
        F.concat_ws("/", "market_id", "delivery_year", "product_id").alias("path"))


@query("date_functions", with_("relations") + """
SELECT fund_account_id, strftime(greatest(st_dt, DATE '1997-01-01'), '%Y%m%d') AS real_begin,
       CAST(datediff('day', st_dt, end_dt) + 1 AS INTEGER) AS held_days,
       strftime(st_dt + 1, '%Y%m%d') AS next_day, strftime(last_day(st_dt), '%Y%m%d') AS month_end,
       strftime(CAST(st_dt - INTERVAL 1 MONTH AS DATE), '%Y%m%d') AS month_before, strftime(end_dt, '%Y-%m-%d') AS end_text
FROM relations""")
def date_functions(spark, sf):
    return S.relations(spark, sf).select(
        "fund_account_id", D.day_key(F.greatest("st_dt", F.lit(date(1997, 1, 1)))).alias("real_begin"),
        (F.datediff("end_dt", "st_dt") + 1).alias("held_days"), D.day_key(F.date_add("st_dt", 1)).alias("next_day"),
        D.day_key(F.last_day("st_dt")).alias("month_end"), D.day_key(F.add_months("st_dt", -1)).alias("month_before"),
        F.date_format("end_dt", "yyyy-MM-dd").alias("end_text"))


@query("contract_month", with_("contract_months") + """
SELECT c.deliv_date, market_id, count(*) AS contracts, CAST(sum(items) AS BIGINT) AS items
FROM contract_months c JOIN (SELECT l_partkey, count(*) AS items FROM lineitem GROUP BY 1) ON l_partkey = security_id
GROUP BY 1, 2""")
def contract_month(spark, sf):
    month = codes.delivery_month("contract_code", "delivery_year", "delivery_month", "delivery_date", "end_delivery_date")
    items = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("security_id")).agg(F.count(F.lit(1)).alias("items"))
    return (S.securities(spark, sf).join(items, "security_id").groupBy(month.alias("deliv_date"), "market_id")
            .agg(F.count(F.lit(1)).alias("contracts"), F.sum("items").alias("items")))


@query("listed_contract_month", with_("securities") + """
SELECT trade_type, market_id, CASE WHEN trade_type = '11' THEN '1' || right(contract_code, 3)
       WHEN market_id = 'CZCE' THEN '1' || substr(contract_code, 3, 3) WHEN market_id = 'DCE' THEN substr(contract_code, 2, 4)
       WHEN market_id = 'SSE' THEN substr(contract_code, 8, 4) END AS listed_month, count(*) AS items
FROM (SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN '11' WHEN 'N' THEN '12' ELSE '21' END AS trade_type FROM lineitem)
JOIN securities ON l_partkey = security_id GROUP BY 1, 2, 3""")
def listed_contract_month(spark, sf):
    items = S.house_fills(spark, sf).groupBy("security_id", "trade_type").agg(F.count(F.lit(1)).alias("items"))
    return (items.join(S.securities(spark, sf), "security_id")
            .groupBy("trade_type", "market_id", codes.listed_contract_month("contract_code", "trade_type", "market_id").alias("listed_month"))
            .agg(F.sum("items").alias("items")))


BIRTH_SQL = """SELECT *, try_strptime(CASE length(id_no) WHEN 18 THEN substr(id_no, 7, 8)
  WHEN 15 THEN '19' || substr(id_no, 7, 6) END, '%Y%m%d')::DATE AS birth FROM accounts"""


def band_sql(c: str, edges) -> str:
    """The bands as a CASE."""
    whens = " ".join(f"WHEN {c} <= DATE '{e}' THEN '{i}'" for i, e in enumerate(edges))
    return f"CASE {whens} WHEN {c} IS NOT NULL THEN '{len(edges)}' END"


@query("age_and_opening_bands", with_("accounts", aged=BIRTH_SQL) + f"""
SELECT {band_sql('birth', codes.BIRTH_EDGES)} AS age_band,
       {band_sql('open_date', ('1995-12-31', '1996-12-31', '1998-06-30', '2000-12-31'))} AS open_band,
       count(*) AS clients, round(sum(acctbal), 2) AS balance FROM aged GROUP BY 1, 2""")
def age_and_opening_bands(spark, sf):
    birth = codes.birth_from_id("id_no")
    edges = [date.fromisoformat(e) for e in codes.BIRTH_EDGES]
    opened = [date(1995, 12, 31), date(1996, 12, 31), date(1998, 6, 30), date(2000, 12, 31)]
    return S.accounts(spark, sf).groupBy(
        M.bucketize(birth, edges, codes.BAND_LABELS).alias("age_band"),
        M.bucketize("open_date", opened, codes.BAND_LABELS).alias("open_band")
    ).agg(F.count(F.lit(1)).alias("clients"), M.money_sum("acctbal").alias("balance"))


@query("conditional_sums", with_("fills") + """
SELECT fund_account_id, round(coalesce(sum(CASE WHEN bs_direction = '0' THEN done_sum END), 0), 2) AS bought,
       round(coalesce(sum(CASE WHEN bs_direction = '1' THEN done_sum END), 0), 2) AS sold,
       round(coalesce(sum(CASE WHEN trade_order = '3' THEN transfee END), 0), 2) AS same_day_fee,
       round(coalesce(sum(CASE WHEN force_flag = '1' THEN done_amt END), 0), 2) AS forced_amount,
       count(CASE WHEN force_flag = '1' THEN 1 END) AS forced_number FROM fills GROUP BY 1""")
def conditional_sums(spark, sf):
    side, forced = F.col("bs_direction"), F.col("force_flag") == "1"
    return S.fills(spark, sf).groupBy("fund_account_id").agg(
        *M.cond_sums({"bought": (side == "0", "done_sum"), "sold": (side == "1", "done_sum"),
                      "same_day_fee": (F.col("trade_order") == "3", "transfee"),
                      "forced_amount": (forced, "done_amt")}),
        M.cond_count(forced).alias("forced_number"))


# ---- joins ------------------------------------------------------------------------------------

@query("inner_join", with_("fills", "securities") + """
SELECT market_id, trade_type, count(*) AS fills, round(sum(done_sum), 2) AS money
FROM fills JOIN securities USING (security_id) GROUP BY 1, 2""")
def inner_join(spark, sf):
    per = S.fills(spark, sf).groupBy("security_id", "trade_type").agg(
        F.count(F.lit(1)).alias("fills"), M.money_sum("done_sum").alias("money"))
    return (per.join(S.securities(spark, sf), "security_id").groupBy("market_id", "trade_type")
            .agg(F.sum("fills").alias("fills"), M.money_sum("money").alias("money")))


@query("left_join_two_keys", with_("client_sett", "fills", sett="""
  SELECT busi_date, fund_account_id, round(sum(rights), 2) AS rights FROM client_sett GROUP BY 1, 2""", done="""
  SELECT busi_date, fund_account_id, round(sum(done_sum), 2) AS done_sum FROM fills GROUP BY 1, 2""") + """
SELECT strftime(s.busi_date, '%Y%m%d') AS busi_date, s.fund_account_id, rights, coalesce(done_sum, 0) AS done_money
FROM sett s LEFT JOIN done d ON s.busi_date = d.busi_date AND s.fund_account_id = d.fund_account_id""")
def left_join_two_keys(spark, sf):
    keys = ["busi_date", "fund_account_id"]
    sett = S.client_sett(spark, sf).groupBy(*keys).agg(*M.sums(["rights"]))
    done = S.fills(spark, sf).groupBy(*keys).agg(M.money_sum("done_sum").alias("done_money"))
    return (sett.join(done, keys, "left").fillna(0.0, ["done_money"])
            .select(D.day_key("busi_date").alias("busi_date"), "fund_account_id", "rights", "done_money"))


@query("full_outer_join", """
SELECT coalesce(o.k, l.k) AS fund_account_id, coalesce(o.total, 0) AS ordered, coalesce(l.total, 0) AS supplied
FROM (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) o
FULL JOIN (SELECT l_suppkey AS k, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1) l ON o.k = l.k""")
def full_outer_join(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("fund_account_id")).agg(M.money_sum("o_totalprice").alias("ordered"))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("fund_account_id")).agg(M.money_sum("l_extendedprice").alias("supplied"))
    return o.join(li, "fund_account_id", "full").fillna(0.0)


@query("left_anti_join", with_("ledger", "excluded_books") + """
SELECT account_period, book_code, round(sum(local_credit_sum), 2) AS amount FROM ledger
WHERE book_code NOT IN (SELECT book_code FROM excluded_books) GROUP BY 1, 2""")
def left_anti_join(spark, sf):
    per = S.ledger(spark, sf).groupBy("account_period", "book_code").agg(M.money_sum("local_credit_sum").alias("amount"))
    return per.join(S.excluded_books(spark, sf), "book_code", "left_anti")


@query("share_of_total", with_("fills", per="""
  SELECT fund_account_id % 25 AS branch, round(sum(done_sum), 2) AS money FROM fills GROUP BY 1""") + """
SELECT branch, money, (SELECT round(sum(done_sum), 2) FROM fills) AS market_money,
       CASE WHEN (SELECT round(sum(done_sum), 2) FROM fills) <> 0
            THEN money / (SELECT round(sum(done_sum), 2) FROM fills) ELSE 0 END AS share FROM per""")
def share_of_total(spark, sf):
    fills = S.fills(spark, sf).groupBy((F.col("fund_account_id") % 25).alias("branch")).agg(M.money_sum("done_sum").alias("money"))
    both = J.against_total(fills, fills.agg(M.money_sum("money").alias("market_money")))
    return both.withColumn("share", M.safe_ratio("money", "market_money"))


@query("indicator_scaffold", with_("branch_map", sold="""
  SELECT c_nationkey, o_orderpriority, round(sum(o_totalprice), 2) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""", kinds="SELECT DISTINCT o_orderpriority FROM orders") + """
SELECT oa_branch_id, k.o_orderpriority AS indicator, coalesce(total, 0) AS total
FROM branch_map CROSS JOIN kinds k LEFT JOIN sold s ON s.c_nationkey = ctp_branch_id AND s.o_orderpriority = k.o_orderpriority
WHERE oa_branch_id IS NOT NULL""")
def indicator_scaffold(spark, sf):
    kinds = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("indicator")).distinct()
    spots = J.scaffold(S.branch_map(spark, sf).filter("oa_branch_id IS NOT NULL"), kinds)
    per_client = table(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("indicator")).agg(M.money_sum("o_totalprice").alias("total"))
    sold = (per_client.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_nationkey").alias("ctp_branch_id"), "indicator").agg(*M.sums(["total"])))
    return (spots.join(sold, ["ctp_branch_id", "indicator"], "left").fillna(0.0, ["total"])
            .select("oa_branch_id", "indicator", "total"))


@query("effective_rate_join", with_("client_sett", "rates", per="""
  SELECT busi_date, fund_account_id % 50 AS grp, round(sum(rights), 2) AS rights FROM client_sett GROUP BY 1, 2""") + """
SELECT grp, coalesce(interest_rate, 1) AS interest_rate, round(sum(rights), 2) AS rights, count(*) AS days
FROM per LEFT JOIN rates ON busi_date BETWEEN begin_date AND end_date GROUP BY 1, 2""")
def effective_rate_join(spark, sf):
    per = S.client_sett(spark, sf).groupBy("busi_date", (F.col("fund_account_id") % 50).alias("grp")).agg(*M.sums(["rights"]))
    rated = J.effective_rate(per, S.rates(spark, sf), S.calendar(spark, sf), default=1.0)
    return rated.groupBy("grp", "interest_rate").agg(M.money_sum("rights").alias("rights"), F.count(F.lit(1)).alias("days"))


def _org_rollup(level):
    def run(spark, sf):
        return orgs.org_rollup(
            S.client_sett(spark, sf), ["rights", "fund_in"], S.accounts(spark, sf), S.branch_map(spark, sf),
            S.units(spark, sf), level, group={"client_type": F.col("client_type")}, account_cols=["client_type"])
    return run


for _level in ("unit", "line", "respons"):
    query(f"org_rollup_{_level}", with_("client_sett", "accounts", f"org_{_level}") + f"""
SELECT org_id, client_type, round(sum(rights), 2) AS rights, round(sum(fund_in), 2) AS fund_in
FROM client_sett s JOIN accounts a ON s.fund_account_id = a.fund_account_id
JOIN org_{_level} o ON a.branch_id = o.branch_id GROUP BY 1, 2""")(_org_rollup(_level))


@query("cohort_semi_join", with_("client_sett") + """
SELECT sett_type, count(*) AS settlements, round(sum(rights), 2) AS rights FROM client_sett
WHERE fund_account_id IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity >= 49)
GROUP BY 1""")
def cohort_semi_join(spark, sf):
    big = table(spark, sf, "lineitem").filter(F.col("l_quantity") >= 49).select("l_orderkey")
    cohort = (table(spark, sf, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
              .select(F.col("o_custkey").alias("fund_account_id")).distinct())
    per = S.client_sett(spark, sf).groupBy("fund_account_id", "sett_type").agg(
        F.count(F.lit(1)).alias("settlements"), *M.sums(["rights"]))
    return (per.join(cohort, "fund_account_id", "left_semi").groupBy("sett_type")
            .agg(F.sum("settlements").alias("settlements"), *M.sums(["rights"])))


@query("entity_match", with_("accounts", sales="""
  SELECT ' ' || id_no AS id_no, client_name, round(sum(o_totalprice), 2) AS share
  FROM orders JOIN accounts ON o_custkey = fund_account_id GROUP BY 1, 2""") + """
SELECT branch_id, count(*) AS clients, round(sum(share), 2) AS share
FROM sales s JOIN accounts a ON trim(s.id_no) = a.id_no AND s.client_name = a.client_name GROUP BY 1""")
def entity_match(spark, sf):
    acc = S.accounts(spark, sf)
    shares = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("fund_account_id")).agg(
        M.money_sum("o_totalprice").alias("share"))
    sales = shares.join(acc, "fund_account_id").select(F.concat(F.lit(" "), "id_no").alias("id_no"), "client_name", "share")
    return (J.entity_match(sales, acc.select("id_no", "client_name", "branch_id")).groupBy("branch_id")
            .agg(F.count(F.lit(1)).alias("clients"), *M.sums(["share"])))


@query("cohort_split", """
SELECT cohort, count(*) AS clients, CAST(sum(k) AS BIGINT) AS key_sum FROM (
  SELECT k, CASE WHEN p = 1 AND c = 1 THEN 'kept' WHEN c = 1 THEN 'new' ELSE 'lost' END AS cohort FROM (
    SELECT o_custkey AS k, max(CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END) AS p,
           max(CASE WHEN year(o_orderdate) = 1998 THEN 1 ELSE 0 END) AS c
    FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1)) GROUP BY 1""")
def cohort_split(spark, sf):
    def of(year):
        return (table(spark, sf, "orders").filter(F.col("o_orderdate").between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31))))
                .select(F.col("o_custkey").alias("k")))
    return (J.cohort_split(of(1997), of(1998), ["k"]).groupBy("cohort")
            .agg(F.count(F.lit(1)).alias("clients"), F.sum("k").alias("key_sum")))


# ---- aggregations -------------------------------------------------------------------------------

SETT_MEASURES = ["rights", "yes_rights", "fund_in", "fund_out", "margin", "today_profit", "transfee", "market_transfee"]


@query("group_sums", with_("client_sett") + "SELECT branch_id, sett_type, " + ", ".join(
    f"round(sum({m}), 2) AS {m}" for m in SETT_MEASURES) + " FROM client_sett GROUP BY 1, 2")
def group_sums(spark, sf):
    return S.client_sett(spark, sf).groupBy("branch_id", "sett_type").agg(*M.sums(SETT_MEASURES))


@query("distinct_counts", with_("fills") + """
SELECT fund_account_id % 25 AS branch, count(*) AS fills, count(DISTINCT busi_date) AS days,
       count(DISTINCT security_id) AS contracts, max(done_sum) AS largest, min(done_sum) AS smallest FROM fills GROUP BY 1""")
def distinct_counts(spark, sf):
    return S.fills(spark, sf).groupBy((F.col("fund_account_id") % 25).alias("branch")).agg(
        F.count(F.lit(1)).alias("fills"), F.countDistinct("busi_date").alias("days"),
        F.countDistinct("security_id").alias("contracts"), F.max("done_sum").alias("largest"), F.min("done_sum").alias("smallest"))


@query("string_aggregation", """
SELECT o_orderstatus, string_agg(DISTINCT CAST(o_custkey AS VARCHAR), '/' ORDER BY CAST(o_custkey AS VARCHAR)) AS clients FROM orders GROUP BY 1""")
def string_aggregation(spark, sf):
    """Every client with an order of a status: groups as large as the customer table."""
    return strings.ordered_concat(table(spark, sf, "orders"), ["o_orderstatus"], "o_custkey", "clients")


@query("nested_distinct_counts", with_("fills", p="""
  SELECT fund_account_id, security_id, strftime(busi_date, '%Y%m') AS m, strftime(busi_date, '%Y') || CAST(quarter(busi_date) AS VARCHAR) AS q,
         strftime(busi_date, '%Y') AS y FROM fills""") + " UNION ALL ".join(f"""
SELECT security_id % 10 AS class, '{g}' AS grain, {c} AS period, count(DISTINCT fund_account_id) AS clients FROM p GROUP BY 1, 2, 3"""
    for g, c in (("month", "m"), ("quarter", "q"), ("year", "y"))))
def nested_distinct_counts(spark, sf):
    """Traded clients of a month, quarter and year from one scan."""
    df = S.fills(spark, sf).select((F.col("security_id") % 10).alias("class"), "fund_account_id", "busi_date")
    return distinct.nested_distinct(df, ["class"], "fund_account_id", "busi_date", "clients")


_SPOTS = """
  SELECT c_nationkey AS nation, s_name AS unit, period FROM (SELECT DISTINCT c_nationkey FROM customer)
  JOIN supplier ON s_nationkey = c_nationkey CROSS JOIN (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period FROM orders)"""


@query("running_totals", with_(spots=_SPOTS, facts="""
  SELECT s_name AS unit, s_nationkey AS nation, strftime(l_shipdate, '%Y%m') AS period, l_partkey, l_returnflag,
         l_extendedprice FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""", monthly="""
  SELECT unit, nation, period, round(sum(l_extendedprice), 2) AS v, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS r FROM facts GROUP BY 1, 2, 3""", sums="""
  SELECT s.unit, s.nation, s.period, round(coalesce(sum(m.v), 0), 2) AS sold_ever, round(coalesce(sum(CASE WHEN substr(m.period, 1, 4) = substr(s.period, 1, 4) THEN m.r END), 0), 2) AS returned_this_year
  FROM spots s LEFT JOIN monthly m ON m.unit = s.unit AND m.nation = s.nation AND m.period <= s.period GROUP BY 1, 2, 3""", seen="""
  SELECT unit, nation, l_partkey, min(period) AS period FROM facts GROUP BY unit, nation, l_partkey, substr(period, 1, 4)""") + """
SELECT sums.*, CAST(count(f.l_partkey) AS DOUBLE) AS parts_this_year FROM sums LEFT JOIN seen f
  ON f.unit = sums.unit AND f.nation = sums.nation AND substr(f.period, 1, 4) = substr(sums.period, 1, 4) AND f.period <= sums.period GROUP BY ALL""")
def running_totals(spark, sf):
    """Suppliers' sales at every month of the orders, whether or not they sold in it."""
    sup = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("unit"), F.col("s_nationkey").alias("nation"))
    nations = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    months = table(spark, sf, "orders").select(D.month_key("o_orderdate").alias("period")).distinct()
    spots = J.scaffold(sup.join(nations, "nation").select("unit", "nation"), months)
    facts = table(spark, sf, "lineitem").join(sup, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("period", D.month_key("l_shipdate"))
    keys = ["unit", "nation"]
    sums = running.running_totals({
        "sold_ever": (facts, "l_extendedprice", "ever", 2),
        "returned_this_year": (facts, F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")), "year", 2)}, spots, keys)
    return sums.join(running.running_distinct(facts, "l_partkey", "parts_this_year", spots, keys), [*keys, "period"])


@query("computed_key_groups", """
SELECT CASE WHEN l_discount >= 0.05 THEN 'high' WHEN l_tax > 0.04 THEN 'taxed' ELSE 'plain' END AS kind,
       CAST(floor(l_quantity / 10) AS BIGINT) AS size_class, count(*) AS items, round(sum(l_extendedprice), 2) AS total
FROM lineitem GROUP BY 1, 2""")
def computed_key_groups(spark, sf):
    kind = F.when(F.col("l_discount") >= 0.05, "high").when(F.col("l_tax") > 0.04, "taxed").otherwise("plain")
    return table(spark, sf, "lineitem").groupBy(kind.alias("kind"), F.floor(F.col("l_quantity") / 10).alias("size_class")).agg(
        F.count(F.lit(1)).alias("items"), M.money_sum("l_extendedprice").alias("total"))


@query("semi_additive_balances", with_("client_sett", "daymap", "months", per="""
  SELECT fund_account_id, busi_date, round(sum(rights), 2) AS rights, round(sum(yes_rights), 2) AS yes_rights
  FROM client_sett GROUP BY 1, 2""", j="""
  SELECT p.fund_account_id, d.month, d.busi_date AS n_date, p.busi_date, p.rights, p.yes_rights, m.*
  EXCLUDE (month) FROM per p JOIN daymap d ON p.busi_date = d.trade_date JOIN months m ON m.month = d.month""") + """
SELECT fund_account_id, month AS period,
       round(coalesce(sum(CASE WHEN n_date = busi_date AND n_date = first_trade THEN yes_rights END), 0), 2) AS opening,
       round(coalesce(sum(CASE WHEN n_date = busi_date AND n_date = last_trade THEN rights END), 0), 2) AS closing,
       max(CASE WHEN n_date = busi_date THEN rights END) AS highest,
       round(coalesce(sum(CASE WHEN n_date = busi_date THEN rights END), 0), 2) / max(trade_days) AS avg_trade,
       round(sum(rights), 2) / max(natural_days) AS avg_natural,
       max(trade_days) AS trade_days, max(natural_days) AS natural_days FROM j GROUP BY 1, 2""")
def semi_additive_balances(spark, sf):
    return balances.semi_additive(S.client_sett(spark, sf), ["fund_account_id"], "rights", S.calendar(spark, sf),
                                  "month", "yes_rights")


@query("two_stage_totals", with_("client_sett", "accounts", "org_unit", per="""
  SELECT s.fund_account_id, org_id, open_date >= DATE '1998-01-01' AS is_new, round(sum(rights), 2) AS rights
  FROM client_sett s JOIN accounts a ON a.fund_account_id = s.fund_account_id JOIN org_unit o ON o.branch_id = a.branch_id
  GROUP BY 1, 2, 3""") + """
SELECT org_id, is_new, count(*) AS clients, round(sum(rights), 2) AS rights, max(rights) AS largest FROM per GROUP BY 1, 2""")
def two_stage_totals(spark, sf):
    per = S.client_sett(spark, sf).groupBy("fund_account_id").agg(*M.sums(["rights"]))
    placed = orgs.attach_org(per, S.accounts(spark, sf), S.branch_map(spark, sf), account_cols=["open_date"])
    return placed.groupBy("org_id", (F.col("open_date") >= F.lit(date(1998, 1, 1))).alias("is_new")).agg(
        F.count(F.lit(1)).alias("clients"), M.money_sum("rights").alias("rights"), F.max("rights").alias("largest"))


@query("category_pivot", with_("client_sett", "accounts") + """
SELECT a.branch_id, round(coalesce(sum(CASE WHEN client_type = '0' THEN rights END), 0), 2) AS rights_0,
       round(coalesce(sum(CASE WHEN client_type = '1' THEN rights END), 0), 2) AS rights_1,
       round(coalesce(sum(CASE WHEN client_type IN ('3', '4') THEN rights END), 0), 2) AS rights_3
FROM client_sett s JOIN accounts a ON a.fund_account_id = s.fund_account_id GROUP BY 1""")
def category_pivot(spark, sf):
    kind = F.col("client_type")
    per = S.client_sett(spark, sf).groupBy("fund_account_id").agg(*M.sums(["rights"]))
    return (per.join(S.accounts(spark, sf), "fund_account_id").groupBy("branch_id")
            .agg(*M.cond_sums({"rights_0": (kind == "0", "rights"), "rights_1": (kind == "1", "rights"),
                               "rights_3": (kind.isin("3", "4"), "rights")})))


@query("sign_flag", with_("client_sett") + """
SELECT fund_account_id, CASE WHEN round(sum(today_profit), 2) > 0 THEN 0 WHEN round(sum(today_profit), 2) = 0 THEN 1 ELSE 2 END AS flag,
       round(sum(today_profit), 2) AS today_profit FROM client_sett GROUP BY 1""")
def sign_flag(spark, sf):
    total = M.money_sum("today_profit")
    return S.client_sett(spark, sf).groupBy("fund_account_id").agg(
        F.when(total > 0, 0).when(total == 0, 1).otherwise(2).alias("flag"), total.alias("today_profit"))


@query("deduplicated", with_("fills") + "SELECT DISTINCT fund_account_id, trade_type, market FROM (SELECT f.*, security_id % 7 AS market FROM fills f)")
def deduplicated(spark, sf):
    return (S.fills(spark, sf).select("fund_account_id", "trade_type", (F.col("security_id") % 7).alias("market"))
            .dropDuplicates(["fund_account_id", "trade_type", "market"]))


# ---- windows, top-n, sets -------------------------------------------------------------------------

@query("ranked_measures", with_("client_sett", per="""
  SELECT branch_id, fund_account_id, round(sum(rights), 2) AS rights, round(sum(today_profit), 2) AS profit
  FROM client_sett GROUP BY 1, 2""") + """
SELECT branch_id, fund_account_id, CAST(rank() OVER (PARTITION BY branch_id ORDER BY rights DESC) AS INTEGER) AS rank_rights,
       CAST(rank() OVER (PARTITION BY branch_id ORDER BY profit) AS INTEGER) AS rank_loss FROM per""")
def ranked_measures(spark, sf):
    per = S.client_sett(spark, sf).groupBy("branch_id", "fund_account_id").agg(
        M.money_sum("rights").alias("rights"), M.money_sum("today_profit").alias("profit"))
    ranked = R.rank_within(per, ["branch_id"], "rights", "rank_rights")
    ranked = R.rank_within(ranked, ["branch_id"], "profit", "rank_loss", descending=False)
    return ranked.select("branch_id", "fund_account_id", "rank_rights", "rank_loss")


@query("top_rows_numbered", """
SELECT n_name, c_custkey, rank_no, value, index_type FROM (
  SELECT n_name, c_custkey, c_acctbal AS value, 'balance' AS index_type,
         CAST(row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank_no
  FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE rank_no <= 3""")
def top_rows_numbered(spark, sf):
    df = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return R.top_n(df, ["n_name"], {"balance": ("c_acctbal", "desc")}, 3, ["c_custkey"], ties="row_number")


@query("latest_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return (R.latest_per_key(df, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
            .select("o_custkey", "o_orderkey", "o_totalprice"))


@query("component_spine", with_("house_fills", o="""
  SELECT busi_date, fund_account_id, trade_type, round(sum(done_sum), 2) AS m, round(sum(done_amt), 2) AS n
  FROM house_fills WHERE trade_order = '1' GROUP BY 1, 2, 3""", c="""
  SELECT busi_date, fund_account_id, trade_type, round(sum(close_money_today), 2) AS m
  FROM house_fills WHERE trade_order = '3' GROUP BY 1, 2, 3""") + """
SELECT strftime(coalesce(o.busi_date, c.busi_date), '%Y%m%d') AS busi_date,
       coalesce(o.fund_account_id, c.fund_account_id) AS fund_account_id, coalesce(o.trade_type, c.trade_type) AS trade_type,
       coalesce(o.m, 0) AS opened_done_sum, coalesce(o.n, 0) AS opened_done_amt, coalesce(c.m, 0) AS closed_close_money_today
FROM o FULL JOIN c ON o.busi_date = c.busi_date AND o.fund_account_id = c.fund_account_id AND o.trade_type = c.trade_type""")
def component_spine(spark, sf):
    rows, keys = S.house_fills(spark, sf), ["busi_date", "fund_account_id", "trade_type"]
    out = spine.spine_merge({"opened": (rows.filter("trade_order = '1'"), ["done_sum", "done_amt"]),
                             "closed": (rows.filter("trade_order = '3'"), ["close_money_today"])}, keys)
    return out.withColumn("busi_date", D.day_key("busi_date"))


@query("key_spine", """
SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT l_partkey FROM lineitem""")
def key_spine(spark, sf):
    item = table(spark, sf, "lineitem")
    return spine.key_spine([table(spark, sf, "orders").select(F.col("o_custkey").alias("k")),
                            item.select(F.col("l_suppkey").alias("k")), item.select(F.col("l_partkey").alias("k"))], ["k"])


@query("union_of_results", """
SELECT 'order' AS kind, o_custkey AS id, o_totalprice AS money, o_orderstatus AS note FROM orders
UNION ALL SELECT 'supply', l_suppkey, l_extendedprice, NULL FROM lineitem""")
def union_of_results(spark, sf):
    a = table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_custkey").alias("id"),
                                          F.col("o_totalprice").alias("money"), F.col("o_orderstatus").alias("note"))
    b = table(spark, sf, "lineitem").select(F.lit("supply").alias("KIND"), F.col("l_suppkey").alias("ID"),
                                            F.col("l_extendedprice").alias("MONEY"))
    return spine.union_all([a, b])


# ---- table changes ----------------------------------------------------------------------------------

@query("merge_update", with_(src="""
  SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS bal, CASE WHEN count(*) > 12 THEN 'busy' END AS seg
  FROM orders GROUP BY 1""") + """
SELECT c_custkey AS k, CASE WHEN s.k IS NOT NULL AND c_acctbal < s.bal THEN s.bal ELSE c_acctbal END AS bal,
       CASE WHEN s.k IS NOT NULL AND c_acctbal < s.bal THEN coalesce(s.seg, c_mktsegment) ELSE c_mktsegment END AS seg
FROM customer LEFT JOIN src s ON s.k = c_custkey""")
def merge_update(spark, sf):
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"),
                                                 F.col("c_mktsegment").alias("seg"))
    source = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        M.money_sum("o_totalprice").alias("bal"), F.when(F.count(F.lit(1)) > 12, "busy").alias("seg"))
    return merge.merge_update(target, source, ["k"], ["bal", "seg"], cond="a.bal < b.bal")


@query("bucketed_merge", with_(a="""
  SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS bal, CASE WHEN count(*) > 6 THEN 'busy' END AS seg FROM orders WHERE year(o_orderdate) < 1997 GROUP BY 1""", b="""
  SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS bal, CASE WHEN count(*) > 9 THEN 'late' END AS seg FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY 1""", first="""
  SELECT c_custkey AS k, coalesce(a.bal, c_acctbal) AS bal, coalesce(a.seg, c_mktsegment) AS seg FROM customer LEFT JOIN a ON a.k = c_custkey""") + """
SELECT f.k, CASE WHEN f.bal < b.bal THEN b.bal ELSE f.bal END AS bal, CASE WHEN f.bal < b.bal THEN coalesce(b.seg, f.seg) ELSE f.seg END AS seg
FROM first f LEFT JOIN b ON b.k = f.k""")
def bucketed_merge(spark, sf):
    """Two updates, one after the other, of a target that is stored in buckets."""
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    name, folder = f"target_{uuid.uuid4().hex}", scratch(spark)
    buckets.create_target(target, name, ["k"], 16, folder)
    for rule, least, word, cond in ((F.year("o_orderdate") < 1997, 6, "busy", None), (F.year("o_orderdate") >= 1997, 9, "late", "a.bal < b.bal")):
        source = table(spark, sf, "orders").filter(rule).groupBy(F.col("o_custkey").alias("k")).agg(
            M.money_sum("o_totalprice").alias("bal"), F.when(F.count(F.lit(1)) > least, word).alias("seg"))
        buckets.merge_into(spark, name, source, ["bal", "seg"], folder, cond)
    return spark.table(name)


@query("insert_missing", """
SELECT s_suppkey AS k, s_name AS name, CAST(s_nationkey AS INTEGER) AS nation FROM supplier
UNION ALL SELECT o_custkey, NULL, NULL FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def insert_missing(spark, sf):
    target = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
                                                 F.col("s_nationkey").alias("nation"))
    return merge.insert_missing(target, table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct(), ["k"])


@query("staged_scaffold_update", with_("units") + """
SELECT departmentid AS org_id, coalesce(c.clients, 0) AS clients, coalesce(c.balance, 0) AS balance, coalesce(s.suppliers, 0) AS suppliers
FROM units LEFT JOIN (SELECT n_name, count(*) AS clients, round(sum(c_acctbal), 2) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) c ON c.n_name = departmentid
LEFT JOIN (SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) s
  ON s.n_name = departmentid WHERE canceled IS NULL""")
def staged_scaffold_update(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("org_id"))
    per_nation = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("clients"), M.money_sum("c_acctbal").alias("balance"))
    sup = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    base = S.units(spark, sf).filter("canceled IS NULL").select(F.col("departmentid").alias("org_id"))
    return merge.merge_many(base, [(per_nation.join(nation, "n_nationkey"), ["clients", "balance"]),
                                   (sup.join(nation, "n_nationkey"), ["suppliers"])], ["org_id"], default=0)
