"""Code-to-label rules, contract months, birth dates from identity numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import _c, parse_day

# Labels and codes the reports print.
RELATION_LABELS = {"301": "居间关系", "001": "开发关系", "002": "服务关系", "003": "维护关系"}
RELATION_STATUS = {"A": "有效", "S": "停止使用"}
APPROVAL_STATUS = {"0": "审核通过", "1": "审核不通过", "2": "等待审核"}
# Fixed values: (index_type, benchmark) to target indicator code.
INDICATOR_CODES = {
    ("0", "1"): "001", ("1", "1"): "002", ("0", "2"): "003", ("1", "2"): "004",
    ("0", "3"): "005", ("0", "4"): "006", ("1", "4"): "007", ("0", "5"): "008",
    ("1", "5"): "009", ("0", "7"): "012",
}
# Benchmark 6 is split by the indicator's name; the narrower name is first.
NAMED_INDICATORS = (("新增直接开发有效客户数量", "010"), ("新增有效客户数量", "011"))
# Decade of birth and opening-year bands (inclusive upper edges).
BIRTH_EDGES = ("1969-12-31", "1979-12-31", "1989-12-31", "1999-12-31")
OPEN_EDGES = ("2018-12-31", "2019-12-31", "2020-12-31", "2021-12-31")
BAND_LABELS = ("0", "1", "2", "3", "4")


def label_map(code: Column | str, mapping: Mapping[str, str], default: str = "-") -> Column:
    """CASE from code to label."""
    c = _c(code)
    out = None
    for key, label in mapping.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return out.otherwise(F.lit(default))


def indicator_code(index_type: Column | str, benchmark: Column | str, name: Column | str) -> Column:
    """Target indicator code ``001`` to ``012``; empty text when nothing matches."""
    kind, bench, text = _c(index_type), _c(benchmark), _c(name)
    named = F.lit("")
    for phrase, code in reversed(NAMED_INDICATORS):
        named = F.when(text.contains(phrase), code).otherwise(named)
    pair = label_map(F.concat_ws("|", kind, bench),
                     {"|".join(k): v for k, v in INDICATOR_CODES.items()}, "")
    return F.when((kind == "0") & (bench == "6"), named).otherwise(pair)


def birth_from_id(id_no: Column | str) -> Column:
    """Birth DATE from an 18- or 15-digit identity number; NULL for any other length."""
    text = F.trim(_c(id_no))
    digits = (F.when(F.length(text) == 18, F.substring(text, 7, 8))
              .when(F.length(text) == 15, F.concat(F.lit("19"), F.substring(text, 7, 6))))
    return parse_day(digits)


def delivery_month(security_id: Column | str, delivery_year: Column | str,
                   delivery_month_no: Column | str, delivery_date: Column | str,
                   end_delivery_date: Column | str) -> Column:
    """Contract month ``yyMM`` from the security master, falling back to the code's digits.

    Dates are ``yyyyMMdd`` text. A last-delivery month that differs from the delivery month
    wins; the contract code's first run of digits is the last resort.
    """
    year, month = _c(delivery_year), _c(delivery_month_no)
    first, last = _c(delivery_date), _c(end_delivery_date)
    return (F.when(F.length(year) == 4, F.concat(F.substring(year, 3, 2), month))
            .otherwise(F.coalesce(F.substring(F.when(F.substring(first, 3, 4) != F.substring(last, 3, 4), last)
                                              .otherwise(F.coalesce(first, last)), 3, 4),
                                  F.regexp_extract(_c(security_id), "[0-9]+", 0))))


def listed_contract_month(security_id: Column | str, trade_type: Column | str,
                          market_id: Column | str) -> Column:
    """Contract month read off the code itself, by each exchange's code layout."""
    code, kind, market = _c(security_id), _c(trade_type), _c(market_id)
    return (F.when(kind == "11", F.concat(F.lit("1"), F.substring(code, -3, 3)))
            .when(market == "CZCE", F.concat(F.lit("1"), F.substring(code, 3, 3)))
            .when(market == "DCE", F.substring(code, 2, 4))
            .when(market == "SSE", F.substring(code, 8, 4)))


def undash(value: Column | str) -> Column:
    return F.regexp_replace(_c(value), "-", "")
