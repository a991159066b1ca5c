"""General-ledger reports: account activity, indicator results, profit statement, row set-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import cond_sum, money_sum, sums
from ..operators.joins import scaffold
from ..operators.merge import insert_missing

# Indicator groups, and the word their vouchers' summary must contain.
REVENUE, COST, PROFIT = "营业收入", "营业支出", "利润总额"
MOVED_OUT = ("营业收入-考核调出金额", "营业支出-考核调出金额", "营业利润-考核调出金额", "利润总额-考核调出金额")
MOVED_IN = ("营业收入-考核调入金额", "营业支出-考核调入金额", "营业利润-考核调入金额", "利润总额-考核调入金额")
OUT_WORD, IN_WORD = "调减", "调增"
# Statement line -> ledger codes, for the books' own figures and for the two
# assessment adjustments.
OWN_LINES = {
    6: (REVENUE, ("6021", "6421")), 7: (REVENUE, ("6011", "6411")), 8: (REVENUE, ("6111",)),
    9: (REVENUE, ("6101",)), 10: (REVENUE, ("6061",)), 11: (REVENUE, ("6051",)),
    15: (COST, ("6601", "6404")), 16: (COST, ("6701",)), 17: (COST, ("6402",)),
    19: (PROFIT, ("6301", "630101")), 20: (PROFIT, ("6711", "671101")),
}
MOVED_LINES = {
    6: ("6021", "6421", "642102"), 7: ("6011", "6411"), 8: ("6111",), 9: ("6101",), 10: ("6061",),
    11: ("6051",), 13: ("660143",), 14: ("6403",), 15: ("9999999",), 16: ("6701",), 17: ("6402",),
    19: ("6301",), 20: ("6711",), 22: ("6801",),
}
INCOME_TAX_ACCOUNT = "6801"
SURCHARGE = 0.0072


def account_activity(balance: DataFrame, excluded_books: DataFrame, prefix: str, sign: float = 1,
                     summary: str | None = None) -> DataFrame:
    """Activity per period and book of all accounts under a code prefix, times ``sign``."""
    rows = balance.filter(F.col("account_code").startswith(prefix))
    if summary:
        rows = rows.filter(F.col("summary").contains(summary))
    return (rows.groupBy("account_period", F.col("book_code").alias("book_id"))
            .agg((money_sum("local_credit_sum") * sign).alias("index_value"))
            .join(excluded_books.select(F.col("book_code").alias("book_id")), "book_id", "left_anti"))


def indicator_results(balance: DataFrame, indicators: DataFrame, excluded_books: DataFrame) -> DataFrame:
    """Every indicator of every period and book in one pass.

    The ledger is first summed per period, book, code and summary word. The prefix match then
    becomes an equi-join: each code offers all of its prefixes, and an indicator meets the one
    equal to its own code.
    """
    text = F.coalesce(F.col("summary"), F.lit(""))
    small = (balance.groupBy("account_period", "book_code", "account_code",
                             text.contains(OUT_WORD).alias("is_out"), text.contains(IN_WORD).alias("is_in"))
             .agg(money_sum("local_credit_sum").alias("amount"))
             .join(excluded_books.select("book_code"), "book_code", "left_anti"))
    prefixes = F.transform(F.sequence(F.lit(1), F.length("account_code")),
                           lambda n: F.substring(F.col("account_code"), F.lit(1), n))
    offered = small.withColumn("index_id", F.explode(prefixes))
    group = F.col("index_para_name")
    wanted = (F.when(group.isin(*MOVED_OUT), F.col("is_out")).when(group.isin(*MOVED_IN), F.col("is_in"))
              .otherwise(F.lit(True)))
    return (offered.join(indicators, "index_id").filter(wanted)
            .groupBy(F.col("account_period").alias("busi_month"), F.col("book_code").alias("book_id"),
                     "index_para_name", "index_id", "index_name", "cal_direction")
            .agg(money_sum("amount").alias("__v"))
            .select("busi_month", "book_id", "index_para_name", "index_id", "index_name",
                    (F.col("__v") * F.col("cal_direction")).alias("index_value")))


def _subtotals(df: DataFrame, families: str) -> DataFrame:
    """Subtotals of the column families, in the order in which they depend on each other."""
    steps = (
        lambda p: [f"round({'+'.join(f'{p}{i}' for i in range(6, 12))}, 2) AS {p}5",
                   f"round({'+'.join(f'{p}{i}' for i in range(13, 18))}, 2) AS {p}12"],
        lambda p: [f"round({p}5 - {p}12, 2) AS {p}18"],
        lambda p: [f"round({p}18 + {p}19 - {p}20, 2) AS {p}21"],
        lambda p: [f"round({p}21 - {p}22, 2) AS {p}23"])
    for step in steps:
        df = df.selectExpr("*", *[e for p in families for e in step(p)])
    return df


def _texts(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def profit_statement(results: DataFrame, balance: DataFrame, excluded_books: DataFrame, books: DataFrame,
                     months: DataFrame) -> DataFrame:
    """Profit statement of every book and month.

    Column families: ``b`` own figures, ``c``/``d`` assessment amounts moved out and in,
    ``e`` their sum, ``f`` actual (b + e), ``g`` actual since January. Line numbers: 5 revenue
    (6-11), 12 costs (13-17), 18 operating profit, 21 profit before tax, 23 net profit.
    """
    def line(groups: Sequence[str], codes: Sequence[str], name: str) -> Column:
        return cond_sum(f"index_para_name IN ({_texts(groups)}) AND index_id IN ({_texts(codes)})", "index_value").alias(name)

    lines_ = [line((g,), ids, f"b{n}") for n, (g, ids) in OWN_LINES.items()]
    for p, groups in (("c", MOVED_OUT), ("d", MOVED_IN)):
        lines_ += [line(groups, ids, f"{p}{n}") for n, ids in MOVED_LINES.items()]
    by_book = results.groupBy(F.col("busi_month").alias("month_id"), "book_id").agg(*lines_)
    tax = (account_activity(balance, excluded_books, INCOME_TAX_ACCOUNT)
           .selectExpr("account_period AS month_id", "book_id", "index_value AS b22"))
    keys = ["month_id", "book_id"]
    df = scaffold(books.select("book_id"), months.select("month_id")).join(by_book, keys, "left").join(tax, keys, "left")
    # The surcharge is rounded as a decimal: half cents go up whatever the binary fraction.
    df = df.fillna(0.0).selectExpr("*", "0D AS b13", f"CAST(round(CAST(b6 AS DECIMAL(18, 2)) * {SURCHARGE}BD, 2) AS DOUBLE) AS b14")
    df = _subtotals(df, "bcd")
    lines = range(5, 24)
    df = df.selectExpr(*keys, *[f"{p}{i}" for p in "bcd" for i in lines],
                       *[f"round(c{i} + d{i}, 2) AS e{i}" for i in lines], *[f"round(b{i} + c{i} + d{i}, 2) AS f{i}" for i in lines])
    # Twelve rows at most per book and year.
    year = "(PARTITION BY book_id, substring(month_id, 1, 4) ORDER BY month_id)"
    return df.selectExpr("*", *[f"round(sum(f{i}) OVER {year}, 2) AS g{i}" for i in lines])


def levy_adjustment_rows(existing: DataFrame, branches: DataFrame, months: DataFrame) -> DataFrame:
    """The levy adjustment table with a row for every branch and month; existing rows stay."""
    wanted = scaffold(branches.select("branch_id"), months.select("busi_month"))
    return insert_missing(existing, wanted, ["busi_month", "branch_id"])


def resident_staff(existing: DataFrame, brokers: DataFrame, prefix: str = "ZD") -> DataFrame:
    """The resident-staff table with newly found staff appended."""
    return insert_missing(existing, brokers.filter(F.col("broker_id").startswith(prefix)), ["broker_id"])


def book_lines(statement: DataFrame, book_units: DataFrame, lines: Sequence[str]) -> DataFrame:
    """Statement lines per month and unit."""
    return (statement.join(book_units, "book_id").groupBy("month_id", "oa_branch_id")
            .agg(*sums(lines)))
