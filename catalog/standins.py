"""Brokerage tables seen in the given order-and-item tables.

Each stand-in is written twice, as a DataFrame and as SQL with the same name, columns and
row-level arithmetic: orders are account settlements, items are fills and ledger lines,
customers are accounts, nations are branches, regions are business lines, parts are
contracts and suppliers are staff. Everything is computed from the tables by rule; amounts
are cut to cents per row so that both engines add the same numbers.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginbook.functions.dates import date_spine, day_key

CTES: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name], NEEDS[name] = sql, needs


def with_(*names: str, **extra: str) -> str:
    """A WITH clause holding the named stand-ins and what they need, then ``extra`` ones."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for m in NEEDS[n]:
            add(m)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; the frame (a plan, not data) is kept so that it is resolved once."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared area the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base}/marginbook-{uuid.uuid4().hex}"


def cents(x: Column) -> Column:
    return F.floor(x * 100) / 100


def weekday_only(ts: Column) -> Column:
    """Weekend stamps fall back to Friday: settlements exist on weekdays only."""
    d = ts.cast("date")
    return F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))


# The same as Spark SQL text.
ROLLED = "date_sub(CAST({c} AS DATE), greatest(weekday({c}) - 4, 0))"


def _rolled(c: str) -> str:
    return f"CAST({c} AS DATE) - CAST(greatest(isodow({c}) - 5, 0) AS INTEGER)"


# ---- calendar ---------------------------------------------------------------------------

@lru_cache(maxsize=8)
def _year_span(spark: SparkSession, sf: str) -> tuple[date, date]:
    low, high = table(spark, sf, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return date(low.year, 1, 1) - timedelta(days=15), date(high.year, 12, 31)


@lru_cache(maxsize=64)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Every natural day of the orders' years (and 15 before); weekends and holidays closed."""
    d = F.col("busi_date")
    closed = ((F.weekday(d) >= 5) | ((F.month(d) == 1) & (F.dayofmonth(d) == 1))
              | ((F.month(d) == 10) & (F.dayofmonth(d) <= 3)))
    return date_spine(spark, *_year_span(spark, sf)).select(
        d, F.when(closed, 0).otherwise(1).alias("trade_flag"), F.lit("1").alias("market_no"))


cte("calendar", """
SELECT d AS busi_date, CASE WHEN isodow(d) >= 6 OR (month(d) = 1 AND day(d) = 1)
       OR (month(d) = 10 AND day(d) <= 3) THEN 0 ELSE 1 END AS trade_flag
FROM (SELECT CAST(unnest(generate_series(
        make_date(year((SELECT min(o_orderdate) FROM orders)), 1, 1) - INTERVAL 15 DAY,
        CAST(make_date(year((SELECT max(o_orderdate) FROM orders)), 12, 31) AS TIMESTAMP),
        INTERVAL 1 DAY)) AS DATE) AS d)""")
cte("daymap", """
SELECT busi_date, trade_flag,
       max(CASE WHEN trade_flag = 1 THEN busi_date END) OVER (ORDER BY busi_date) AS trade_date,
       strftime(busi_date, '%Y%m') AS month
FROM calendar""", "calendar")
cte("months", """
SELECT month, min(CASE WHEN trade_flag = 1 THEN busi_date END) AS first_trade,
       max(CASE WHEN trade_flag = 1 THEN busi_date END) AS last_trade,
       CAST(sum(trade_flag) AS BIGINT) AS trade_days, count(*) AS natural_days
FROM daymap GROUP BY month""", "daymap")


# ---- dimensions ---------------------------------------------------------------------------

@lru_cache(maxsize=64)
def accounts(spark: SparkSession, sf: str) -> DataFrame:
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    birth = F.date_add(F.lit(date(1955, 1, 1)), (k * 13 % 18250).cast("int"))
    long_id = F.concat(F.lit("110101"), day_key(birth), F.lpad((k % 10000).cast("string"), 4, "0"))
    short_id = F.concat(F.lit("110101"), F.substring(day_key(birth), 3, 6),
                        F.lpad((k % 1000).cast("string"), 3, "0"))
    return table(spark, sf, "customer").select(
        k.alias("fund_account_id"), k.alias("client_id"), F.col("c_name").alias("client_name"),
        F.when(seg == "BUILDING", "1").when(seg == "MACHINERY", "3").when(seg == "AUTOMOBILE", "4")
        .otherwise("0").alias("client_type"),
        F.col("c_nationkey").alias("branch_id"),
        F.date_add(F.lit(date(1995, 1, 1)), (k * 7 % 2555).cast("int")).alias("open_date"),
        F.when(k % 50 == 7, "unknown").when((k % 4 == 0) & (F.year(birth) < 2000), short_id)
        .otherwise(long_id).alias("id_no"),
        F.col("c_acctbal").alias("acctbal"))


cte("accounts", """
SELECT c_custkey AS fund_account_id, c_custkey AS client_id, c_name AS client_name,
       CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'MACHINERY' THEN '3'
            WHEN 'AUTOMOBILE' THEN '4' ELSE '0' END AS client_type,
       c_nationkey AS branch_id, DATE '1995-01-01' + CAST(c_custkey * 7 % 2555 AS INTEGER) AS open_date,
       CASE WHEN c_custkey % 50 = 7 THEN 'unknown'
            WHEN c_custkey % 4 = 0 AND year(birth) < 2000
            THEN '110101' || strftime(birth, '%y%m%d') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
            ELSE '110101' || strftime(birth, '%Y%m%d') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
       END AS id_no, c_acctbal AS acctbal
FROM (SELECT *, DATE '1955-01-01' + CAST(c_custkey * 13 % 18250 AS INTEGER) AS birth FROM customer)""")


@lru_cache(maxsize=64)
def branch_map(spark: SparkSession, sf: str) -> DataFrame:
    """Branch to unit; the last nation has no unit."""
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("ctp_branch_id"),
        F.when(F.col("n_nationkey") != 24, F.col("n_name")).alias("oa_branch_id"))


cte("branch_map", """
SELECT n_nationkey AS ctp_branch_id, CASE WHEN n_nationkey <> 24 THEN n_name END AS oa_branch_id
FROM nation""")


@lru_cache(maxsize=64)
def units(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_nationkey")
    return (table(spark, sf, "nation")
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("departmentid"), F.col("n_name").alias("shortname"),
                    F.when(n == 23, "1").alias("canceled"), F.col("r_name").alias("business_line_id"),
                    F.when(n % 4 != 3, F.concat(F.lit("R"), (n % 4).cast("string"))).alias("respons_line_id")))


cte("units", """
SELECT n_name AS departmentid, n_name AS shortname, CASE WHEN n_nationkey = 23 THEN '1' END AS canceled,
       r_name AS business_line_id,
       CASE WHEN n_nationkey % 4 <> 3 THEN 'R' || CAST(n_nationkey % 4 AS VARCHAR) END AS respons_line_id
FROM nation JOIN region ON n_regionkey = r_regionkey""")
cte("org_unit", """
SELECT ctp_branch_id AS branch_id, oa_branch_id AS org_id FROM branch_map WHERE oa_branch_id IS NOT NULL""",
    "branch_map")
cte("org_line", """
SELECT ctp_branch_id AS branch_id, business_line_id AS org_id
FROM branch_map JOIN units ON oa_branch_id = departmentid WHERE business_line_id IS NOT NULL""",
    "branch_map", "units")
cte("org_respons", """
SELECT ctp_branch_id AS branch_id, respons_line_id AS org_id
FROM branch_map JOIN units ON oa_branch_id = departmentid WHERE respons_line_id IS NOT NULL""",
    "branch_map", "units")


@lru_cache(maxsize=64)
def securities(spark: SparkSession, sf: str) -> DataFrame:
    k, size, kind = F.col("p_partkey"), F.col("p_size"), F.col("p_type")
    first = F.date_add(F.lit(date(1996, 1, 1)), (k * 31 % 2000).cast("int"))
    return table(spark, sf, "part").select(
        k.alias("security_id"), F.col("p_brand").alias("product_id"), F.col("p_name").alias("product_name"),
        F.when(kind == "STANDARD", "CFFEX").when(kind == "SMALL", "CZCE").when(kind == "MEDIUM", "DCE")
        .when(kind == "LARGE", "SHFE").when(kind == "ECONOMY", "INE").otherwise("SSE").alias("market_id"),
        F.concat(F.lower(F.substring(kind, 1, 2)), F.lpad((k % 10000).cast("string"), 4, "0")).alias("contract_code"),
        F.when(size % 3 == 0, F.year(first).cast("string")).alias("delivery_year"),
        F.lpad(F.month(first).cast("string"), 2, "0").alias("delivery_month"),
        F.when(size % 7 != 0, day_key(first)).alias("delivery_date"),
        F.when(size % 7 != 0, day_key(F.date_add(first, F.when(size % 2 == 0, 40).otherwise(0))))
        .alias("end_delivery_date"))


cte("securities", """
SELECT p_partkey AS security_id, p_brand AS product_id, p_name AS product_name,
       CASE p_type WHEN 'STANDARD' THEN 'CFFEX' WHEN 'SMALL' THEN 'CZCE' WHEN 'MEDIUM' THEN 'DCE'
            WHEN 'LARGE' THEN 'SHFE' WHEN 'ECONOMY' THEN 'INE' ELSE 'SSE' END AS market_id,
       lower(substr(p_type, 1, 2)) || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS contract_code,
       CASE WHEN p_size % 3 = 0 THEN strftime(first, '%Y') END AS delivery_year,
       strftime(first, '%m') AS delivery_month,
       CASE WHEN p_size % 7 <> 0 THEN strftime(first, '%Y%m%d') END AS delivery_date,
       CASE WHEN p_size % 7 <> 0 THEN strftime(first + CASE WHEN p_size % 2 = 0 THEN 40 ELSE 0 END, '%Y%m%d') END
         AS end_delivery_date
FROM (SELECT *, DATE '1996-01-01' + CAST(p_partkey * 31 % 2000 AS INTEGER) AS first FROM part)""")
# Contract month of every security, as the trade reports print it.
cte("contract_months", """
SELECT *, CASE WHEN length(delivery_year) = 4 THEN substr(delivery_year, 3, 2) || delivery_month
     WHEN delivery_date IS NOT NULL AND substr(delivery_date, 3, 4) <> substr(end_delivery_date, 3, 4)
          THEN substr(end_delivery_date, 3, 4)
     WHEN coalesce(delivery_date, end_delivery_date) IS NOT NULL
          THEN substr(coalesce(delivery_date, end_delivery_date), 3, 4)
     ELSE regexp_extract(contract_code, '[0-9]+', 0) END AS deliv_date
FROM securities""", "securities")


@lru_cache(maxsize=64)
def rates(spark: SparkSession, sf: str) -> DataFrame:
    """Interest rate by interval, in percent: five intervals of 500 days."""
    r = F.col("r_regionkey")
    begin = F.date_add(F.lit(date(1995, 1, 1)), r * 500)
    return table(spark, sf, "region").select(
        begin.alias("begin_date"), F.date_add(begin, 499).alias("end_date"),
        (F.lit(1.5371) + r * 0.2513).alias("interest_rate"))


cte("rates", """
SELECT DATE '1995-01-01' + r_regionkey * 500 AS begin_date,
       DATE '1995-01-01' + r_regionkey * 500 + 499 AS end_date,
       1.5371::DOUBLE + r_regionkey * 0.2513::DOUBLE AS interest_rate FROM region""")


@lru_cache(maxsize=64)
def relations(spark: SparkSession, sf: str) -> DataFrame:
    """Staff-client relations: customers served by a broker for a while."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    start = F.date_add(F.lit(date(1995, 6, 1)), (k * 11 % 1500).cast("int"))
    return table(spark, sf, "customer").select(
        F.concat(F.when(k % 3 == 0, "ZD").otherwise("YW"), (k % 40).cast("string")).alias("broker_id"),
        k.alias("fund_account_id"),
        F.when(seg == "BUILDING", "301").when(seg == "MACHINERY", "001").when(seg == "AUTOMOBILE", "002")
        .when(seg == "FURNITURE", "003").otherwise("999").alias("broker_rela_typ"),
        F.when(k % 8 == 5, "S").otherwise("A").alias("rela_sts"),
        (F.when(k % 9 == 4, "1").when(k % 9 == 8, "2").otherwise("0")).alias("approve_sts"),
        start.alias("st_dt"), F.date_add(start, (k * 17 % 900).cast("int")).alias("end_dt"),
        start.alias("approve_dt"),
        F.when(k % 6 != 1, (k % 4 + 1) / 4).alias("data_pct"))


cte("relations", """
SELECT *, st_dt + CAST(fund_account_id * 17 % 900 AS INTEGER) AS end_dt, st_dt AS approve_dt
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'ZD' ELSE 'YW' END || CAST(c_custkey % 40 AS VARCHAR) AS broker_id,
       c_custkey AS fund_account_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN '301' WHEN 'MACHINERY' THEN '001' WHEN 'AUTOMOBILE' THEN '002'
            WHEN 'FURNITURE' THEN '003' ELSE '999' END AS broker_rela_typ,
       CASE WHEN c_custkey % 8 = 5 THEN 'S' ELSE 'A' END AS rela_sts,
       CASE c_custkey % 9 WHEN 4 THEN '1' WHEN 8 THEN '2' ELSE '0' END AS approve_sts,
       DATE '1995-06-01' + CAST(c_custkey * 11 % 1500 AS INTEGER) AS st_dt,
       CASE WHEN c_custkey % 6 <> 1 THEN (c_custkey % 4 + 1) / 4.0::DOUBLE END AS data_pct
FROM customer)""")


# ---- facts --------------------------------------------------------------------------------

# Row-level settlement measures, in the SQL both engines share; {d} marks a double literal.
SETT_COLUMNS = """
o_totalprice AS rights | floor(o_totalprice * 0.9{d} * 100) / 100 AS yes_rights
CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END AS fund_in
CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE 0 END AS fund_out
CASE WHEN o_orderpriority = '2-HIGH' THEN floor(o_totalprice * 0.4{d} * 100) / 100 ELSE 0 END AS impawn_money
floor(o_totalprice * 0.3{d} * 100) / 100 AS margin | floor(o_totalprice * 0.25{d} * 100) / 100 AS market_margin
floor(o_totalprice * 0.6{d} * 100) / 100 AS open_pre_money
floor(o_totalprice * (o_orderkey % 21 - 10) / 100 * 100) / 100 AS today_profit
floor(o_totalprice * 0.02{d} * 100) / 100 AS transfee | floor(o_totalprice * 0.01{d} * 100) / 100 AS market_transfee
CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice * 0.005{d} * 100) / 100 ELSE 0 END AS delivery_transfee
CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice * 0.002{d} * 100) / 100 ELSE 0 END AS market_delivery_transfee
CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice * 0.004{d} * 100) / 100 ELSE 0 END AS strikefee
CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice * 0.001{d} * 100) / 100 ELSE 0 END AS market_strikefee
"""

# Further measures of the settlement table, for the reconciliation reports: each a fixed part of the total, on some rows.
MORE_SETT = ("strikeactreceivsum strikeactpaysum fund_impawn_in fund_impawn_out lastfundmortgagein lastfundmortgageout yes_impawn_money "
             "opt_premium_income opt_premium_pay performfee market_performfee hold_profit hold_profit_f close_profit drop_profit_f "
             "fund_impawn_margin socrt_openfee settlementfee buy_opt_market_value sell_opt_market_value market_deposit optstrike_profit "
             "strike_credit credit execute_transfee market_execute_transfee add_fee1 add_fee2").split()
MORE_SETT_COLUMNS = "\n".join(
    f"CASE WHEN o_orderkey % {i % 4 + 1} = 0 THEN floor(o_totalprice * {(i + 2) / 1000}{{d}} * 100) / 100 ELSE 0 END AS {name}"
    for i, name in enumerate(MORE_SETT))


def _list(listing: str, **names: str) -> list[str]:
    """Column expressions separated by line ends or bars."""
    return [e.strip().format(**names) for line in listing.strip().splitlines() for e in line.split("|")]


@lru_cache(maxsize=64)
def client_sett(spark: SparkSession, sf: str) -> DataFrame:
    """Settlement rows from orders: balances, flows and fees per account and weekday."""
    return table(spark, sf, "orders").selectExpr(
        f"{ROLLED.format(c='o_orderdate')} AS busi_date", "o_custkey AS fund_account_id", "o_custkey AS client_id",
        "CAST(o_custkey % 25 AS INT) AS branch_id", "'1' AS money_type", "o_orderstatus AS sett_type",
        *_list(SETT_COLUMNS, d="D"))


cte("client_sett", f"""
SELECT {_rolled('o_orderdate')} AS busi_date, o_custkey AS fund_account_id, o_custkey AS client_id,
       CAST(o_custkey % 25 AS INTEGER) AS branch_id, '1' AS money_type, o_orderstatus AS sett_type,
       {", ".join(_list(SETT_COLUMNS, d="::DOUBLE"))} FROM orders""")

# Row-level trade measures by account column {a}.
TRADE_COLUMNS = """
{a} AS fund_account_id | {a} AS client_id | CAST({a} % 25 AS INT) AS branch_id | '1' AS money_type | l_partkey AS security_id
CASE l_returnflag WHEN 'A' THEN '11' WHEN 'N' THEN '12' ELSE '21' END AS trade_type
CASE WHEN l_linenumber = 7 THEN '3' WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS trade_prop
CAST(l_linenumber % 2 AS {text}) AS bs_direction | CASE WHEN l_linenumber % 3 = 0 THEN '3' ELSE '1' END AS trade_order
CASE WHEN l_quantity >= 48 THEN '1' ELSE '0' END AS force_flag | l_quantity AS done_amt | l_extendedprice AS done_sum
CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS close_amount_today
CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END AS close_money_today
floor(l_extendedprice * l_tax * 100) / 100 AS transfee | floor(l_extendedprice * l_tax / 2 * 100) / 100 AS market_transfee
floor(l_extendedprice * l_discount * 100) / 100 AS margin | floor(l_extendedprice * l_discount / 2 * 100) / 100 AS market_margin
floor(l_extendedprice * (l_linenumber - 4) / 50 * 100) / 100 AS today_profit
floor(l_extendedprice / l_quantity * 100) / 100 AS sett_price
"""


@lru_cache(maxsize=64)
def wide_sett(spark: SparkSession, sf: str) -> DataFrame:
    """The settlement rows with all measures of the reconciliation reports."""
    return table(spark, sf, "orders").selectExpr(
        f"{ROLLED.format(c='o_orderdate')} AS busi_date", "o_custkey AS fund_account_id", "o_custkey AS client_id",
        "CAST(o_custkey % 25 AS INT) AS branch_id", "'1' AS money_type", "o_orderstatus AS sett_type",
        *_list(SETT_COLUMNS + MORE_SETT_COLUMNS, d="D"))


cte("wide_sett", f"""SELECT {_rolled('o_orderdate')} AS busi_date, o_custkey AS fund_account_id, o_custkey AS client_id,
       CAST(o_custkey % 25 AS INTEGER) AS branch_id, '1' AS money_type, o_orderstatus AS sett_type,
       {", ".join(_list(SETT_COLUMNS + MORE_SETT_COLUMNS, d="::DOUBLE"))} FROM orders""")


@lru_cache(maxsize=64)
def fees(spark: SparkSession, sf: str) -> DataFrame:
    """The fee table: kinds of fee, some out of force or of another level."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.when(k % 2 == 0, "1003").otherwise("1002").alias("fee_type"), F.when(k % 3 == 0, "1").otherwise("0").alias("use_status"),
        F.when(k % 5 == 0, "2").otherwise("1").alias("data_level"), (k % 40 / 4).alias("fee"))


cte("levy", """
SELECT coalesce(max(s_suppkey % 40 / 4) / 100000000, 5.5::DOUBLE / 100000000) AS levy FROM supplier
WHERE s_suppkey % 2 = 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 5 <> 0""")


@lru_cache(maxsize=64)
def fills(spark: SparkSession, sf: str) -> DataFrame:
    """Fills by client account: items, with the account of their order."""
    return (table(spark, sf, "lineitem")
            .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .selectExpr(f"{ROLLED.format(c='l_shipdate')} AS busi_date", *_list(TRADE_COLUMNS, a="o_custkey", text="STRING")))


cte("fills", f"""SELECT {_rolled('l_shipdate')} AS busi_date, {", ".join(_list(TRADE_COLUMNS, a="o_custkey", text="VARCHAR"))}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")


@lru_cache(maxsize=64)
def house_fills(spark: SparkSession, sf: str) -> DataFrame:
    """Fills by house account (the supplier), which the item itself names."""
    return table(spark, sf, "lineitem").selectExpr(
        f"{ROLLED.format(c='l_shipdate')} AS busi_date", *_list(TRADE_COLUMNS, a="l_suppkey", text="STRING"))


cte("house_fills", f"""SELECT {_rolled('l_shipdate')} AS busi_date, {", ".join(_list(TRADE_COLUMNS, a="l_suppkey", text="VARCHAR"))}
FROM lineitem""")


@lru_cache(maxsize=64)
def house_accounts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.alias("fund_account_id"), F.col("s_name").alias("client_name"),
        F.when(k % 3 == 0, "1").otherwise("0").alias("client_type"),
        F.col("s_nationkey").alias("branch_id"),
        F.date_add(F.lit(date(1995, 1, 1)), (k * 7 % 2555).cast("int")).alias("open_date"))


cte("house_accounts", """
SELECT s_suppkey AS fund_account_id, s_name AS client_name,
       CASE WHEN s_suppkey % 3 = 0 THEN '1' ELSE '0' END AS client_type, s_nationkey AS branch_id,
       DATE '1995-01-01' + CAST(s_suppkey * 7 % 2555 AS INTEGER) AS open_date FROM supplier""")

# Ledger account codes, by position.
LEDGER_CODES = ("602101", "642101", "601102", "641103", "6111", "6101", "606101", "6051", "660101",
                "6404", "6701", "6402", "6301", "671101", "6801", "660143", "6403")


@lru_cache(maxsize=64)
def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """General-ledger lines from items: period, account code, book, summary text, amount."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("string").alias("account_period"),
        F.element_at(F.array(*[F.lit(c) for c in LEDGER_CODES]),
                     (F.col("l_partkey") % len(LEDGER_CODES) + 1).cast("int")).alias("account_code"),
        F.concat(F.lit("B"), (F.col("l_suppkey") % 30).cast("string")).alias("book_code"),
        F.when(flag == "A", "普通凭证").when(flag == "N", "考核调减凭证").otherwise("考核调增凭证").alias("summary"),
        F.col("l_extendedprice").alias("local_credit_sum"))


cte("ledger", f"""
SELECT strftime(l_shipdate, '%Y%m') AS account_period,
       ({list(LEDGER_CODES)!r})[CAST(l_partkey % {len(LEDGER_CODES)} + 1 AS INTEGER)] AS account_code,
       'B' || CAST(l_suppkey % 30 AS VARCHAR) AS book_code,
       CASE l_returnflag WHEN 'A' THEN '普通凭证' WHEN 'N' THEN '考核调减凭证' ELSE '考核调增凭证' END AS summary,
       l_extendedprice AS local_credit_sum FROM lineitem""")


@lru_cache(maxsize=64)
def excluded_books(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "supplier").filter(F.col("s_acctbal") < -900)
            .select(F.concat(F.lit("B"), (F.col("s_suppkey") % 30).cast("string")).alias("book_code")).distinct())


cte("excluded_books", """
SELECT DISTINCT 'B' || CAST(s_suppkey % 30 AS VARCHAR) AS book_code FROM supplier WHERE s_acctbal < -900""")


@lru_cache(maxsize=64)
def books(spark: SparkSession, sf: str) -> DataFrame:
    """Books with the unit that owns each."""
    return (table(spark, sf, "supplier").groupBy(
        F.concat(F.lit("B"), (F.col("s_suppkey") % 30).cast("string")).alias("book_id"))
        .agg(F.min("s_nationkey").alias("n")).join(table(spark, sf, "nation"), F.col("n") == F.col("n_nationkey"))
        .select("book_id", F.col("n_name").alias("oa_branch_id")))


cte("books", """
SELECT book_id, n_name AS oa_branch_id FROM (
  SELECT 'B' || CAST(s_suppkey % 30 AS VARCHAR) AS book_id, min(s_nationkey) AS n FROM supplier GROUP BY 1)
JOIN nation ON n = n_nationkey""")
