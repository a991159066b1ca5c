"""Operating targets: actual indicator values, yearly check, target book, completion, assessment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import indicator_code
from ..functions.dates import month_key, quarter_of_month
from ..functions.measures import cond_count, money_sum, nz, safe_ratio, share_pct, sums
from ..operators.calendar import one_market, period_key
from ..operators.joins import scaffold
from ..operators.merge import insert_missing, merge_update
from ..operators.orgs import LEVELS, attach_org
from ..operators.scoring import capped_score, carry_over
from ..operators.spine import spine_merge
from ..sources.scratch import stored
from .income import active_relations
from .ledger import book_lines

# Indicator codes and names.
INDICATORS = [
    ("001", "考核收入"), ("002", "经纪业务手续费收入市占率"), ("003", "考核日均权益"), ("004", "日均权益市占率"),
    ("005", "考核利润"), ("006", "成交额"), ("007", "成交额市占率"), ("008", "成交量"), ("009", "成交量市占率"),
    ("010", "新增直接开发有效客户数量"), ("011", "新增有效客户数量"), ("012", "产品销售额"),
]
SHARES = ("002", "004", "007", "009")
BROKERED = "301"
INDUSTRY_UNIT = 100_000_000


@dataclass(frozen=True)
class TargetSources:
    """Frames the actual values are computed from.

    ``industry`` has monthly market totals ``fee, rights, turnover, volume`` in hundred millions
    (single-sided for the last two); ``sales`` are product confirmations by client identity.
    """

    statement: DataFrame
    book_units: DataFrame
    sett: DataFrame
    trades: DataFrame
    accounts: DataFrame
    branch_map: DataFrame
    relations: DataFrame
    sales: DataFrame
    industry: DataFrame
    calendar: DataFrame


def _of_month(grain: str, month: Column) -> Column:
    year = F.substring(month, 1, 4)
    return {"month": month, "year": year, "quarter": F.concat(year, quarter_of_month(month))}[grain]


@dataclass(frozen=True)
class IndicatorBase:
    """All that the indicators of any month, quarter or year are made of, at month grain.

    ``months`` has one row per month and unit: sums of the statement lines, equity, activity and sales, and for each of them how many
    rows it comes from (a unit without rows of a kind has no indicator of it). ``fresh`` has accounts with the months of
    their opening year in which they paid a fee: whether an account is new in a period can't be added up from months.
    """

    months: DataFrame
    fresh: DataFrame


LINES = ("f5", "f6", "f8", "f18")


def indicator_base(src: TargetSources) -> IndicatorBase:
    """The base of all periods in one pass over each source."""
    days = one_market(src.calendar).filter("trade_flag = 1").select("busi_date", month_key("busi_date").alias("month"))
    one = "1D AS n"

    def per_unit(facts: DataFrame, measures: Sequence[str]) -> DataFrame:
        # The calendar is broadcast, so the facts are shuffled once, after partial sums.
        per_account = facts.join(days, "busi_date").groupBy("month", "fund_account_id").agg(*sums(measures))
        return attach_org(per_account, src.accounts, src.branch_map).selectExpr("month", "org_id", *measures, one)

    lines = book_lines(src.statement, src.book_units, list(LINES)).selectExpr("month_id AS month", "oa_branch_id AS org_id", *LINES, one)
    buyers = (src.sales.filter(F.col("wh_trade_type").isin("0", "1")).groupBy("id_no", "client_name", month_key("busi_date").alias("month"))
              .agg(money_sum("confirm_share").alias("sold")))
    matched = buyers.join(src.accounts.select("id_no", "client_name", "branch_id"), ["id_no", "client_name"])
    sold = attach_org(matched, None, src.branch_map).selectExpr("month", "org_id", "sold", one)
    months = spine_merge({"l": (lines, [*LINES, "n"]), "s": (per_unit(src.sett, ["rights"]), ["rights", "n"]),
                          "t": (per_unit(src.trades, ["done_sum", "done_amt"]), ["done_sum", "done_amt", "n"]), "p": (sold, ["sold", "n"])},
                         ["month", "org_id"])
    listed = one_market(src.calendar).select(F.col("busi_date").alias("open_date"))
    opened = src.accounts.join(listed, "open_date").select("fund_account_id", "branch_id", month_key("open_date").alias("open_month"))
    natural = one_market(src.calendar).select("busi_date", month_key("busi_date").alias("paid_month"))
    paid = src.trades.filter(F.col("transfee") != 0).join(natural, "busi_date").select("fund_account_id", "paid_month").distinct()
    fresh = opened.join(paid, "fund_account_id").filter("substring(open_month, 1, 4) = substring(paid_month, 1, 4)")
    return IndicatorBase(months, attach_org(fresh, None, src.branch_map).select("fund_account_id", "org_id", "open_month", "paid_month"))


def stored_base(base: IndicatorBase) -> IndicatorBase:
    """The base kept in the shared folder: reports of several grains read it and not its sources."""
    return IndicatorBase(stored(base.months), stored(base.fresh))


def new_clients(src: TargetSources, grain: str, base: IndicatorBase | None = None) -> DataFrame:
    """Accounts opened in a period that paid a fee in it, per unit.

    ``direct`` counts those without a brokered relation in the period, ``free`` those without any.
    Relations count when in force, approved and overlapping the period.
    """
    base = base or indicator_base(src)
    days = one_market(src.calendar).select("busi_date", period_key(grain).alias("period"))
    spans = days.groupBy("period").agg(F.min("busi_date").alias("b"), F.max("busi_date").alias("e"))
    keys = ["period", "fund_account_id"]
    opened = (base.fresh.withColumn("period", _of_month(grain, F.col("open_month")))
              .filter(F.col("period") == _of_month(grain, F.col("paid_month"))).select(*keys, "org_id").distinct())
    rel = active_relations(src.relations, None).select("fund_account_id", "broker_rela_typ", "st_dt", "end_dt")
    # Account by account: the range test sees one account's few relations.
    tied = (opened.select(*keys).distinct().join(spans, "period").join(rel, "fund_account_id")
            .filter(F.greatest("st_dt", "b") <= F.least("end_dt", "e"))
            .groupBy(*keys).agg(F.max(F.col("broker_rela_typ") == BROKERED).alias("brokered")))
    return opened.join(tied, keys, "left").groupBy("period", "org_id").agg(
        cond_count("NOT coalesce(brokered, false)").cast("double").alias("direct"),
        cond_count("brokered IS NULL").cast("double").alias("free"))


def indicator_actuals(src: TargetSources, grain: str, base: IndicatorBase | None = None) -> DataFrame:
    """``period, org_id, busi_type, value, industry`` for all twelve indicators of every unit.

    Months are rolled up to the period, one narrow shuffle for all indicators; shares divide by the market's total of the period.
    """
    base = base or indicator_base(src)
    days = one_market(src.calendar).filter("trade_flag = 1").select(period_key(grain).alias("period"))
    counts = days.groupBy("period").agg(F.count(F.lit(1)).alias("days"))
    market = src.industry.groupBy(_of_month(grain, F.col("busi_month")).alias("period")).agg(
        *[(money_sum(c, 6) * INDUSTRY_UNIT).alias(f"all_{c}") for c in ("fee", "rights", "turnover", "volume")])
    measures = [c for c in base.months.columns if c not in ("month", "org_id")]
    u = (base.months.groupBy(_of_month(grain, F.col("month")).alias("period"), "org_id").agg(*sums(measures))
         .join(counts, "period", "left").join(market, "period", "left")
         .withColumn("avg", safe_ratio("s_rights", "days")).withColumn("all_avg", safe_ratio("all_rights", "days")))
    c, none = F.col, F.lit(None).cast("double")
    two_sided = {m: c(f"all_{m}") * 2 for m in ("turnover", "volume")}
    equity = (c("s_n") > 0) & c("days").isNotNull()
    # Code, value, industry, and whether the unit has rows of the kind.
    parts = [("001", c("l_f5"), none, c("l_n") > 0), ("005", c("l_f18"), none, c("l_n") > 0),
             ("002", safe_ratio(F.round(c("l_f6") + c("l_f8"), 2), "all_fee"), c("all_fee"), c("l_n") > 0),
             ("003", c("avg"), none, equity), ("004", safe_ratio("avg", "all_avg"), c("all_avg"), equity),
             ("006", c("t_done_sum"), none, c("t_n") > 0), ("008", c("t_done_amt"), none, c("t_n") > 0),
             ("007", safe_ratio("t_done_sum", two_sided["turnover"]), two_sided["turnover"], c("t_n") > 0),
             ("009", safe_ratio("t_done_amt", two_sided["volume"]), two_sided["volume"], c("t_n") > 0), ("012", c("p_sold"), none, c("p_n") > 0)]
    rows = F.array(*[F.when(known, F.struct(F.lit(code).alias("busi_type"), v.cast("double").alias("value"), i.cast("double").alias("industry")))
                     for code, v, i, known in parts])
    summed = u.select("period", "org_id", F.explode(rows).alias("__r")).filter("__r IS NOT NULL").select("period", "org_id", "__r.*")
    fresh = new_clients(src, grain, base)
    counted = fresh.select("period", "org_id", F.explode(F.array(*[
        F.struct(F.lit(code).alias("busi_type"), c(n).alias("value"), none.alias("industry")) for code, n in (("010", "direct"), ("011", "free"))])).alias("__r"))
    return summed.unionByName(counted.filter("__r.value > 0").select("period", "org_id", "__r.*"))


QUARTERS = (1, 2, 3, 4)
TARGET_KEYS = ["year_id", "oa_branch_id", "index_id"]


def _with_code(targets: DataFrame) -> DataFrame:
    return targets.withColumn("busi_type", indicator_code("index_type", "index_asses_benchmark", "index_name"))


def check_annual_targets(targets: DataFrame, actuals: DataFrame) -> DataFrame:
    """Targets with last year's actual value, growth, quarter shares and the check result.

    A share indicator's quarter targets follow the quarter profile of the absolute indicator of
    the same unit and benchmark. The check passes when the filed rates equal the computed ones
    (absolute) or the four quarters add up to the year (share).
    """
    last = actuals.select((F.col("period").cast("int") + 1).cast("string").alias("year_id"),
                          F.col("org_id").alias("oa_branch_id"), "busi_type", F.col("value").alias("last_year_complet_value"))
    t = _with_code(targets).join(last, ["year_id", "oa_branch_id", "busi_type"], "left")
    t = t.withColumn("growth_rate", F.when(F.col("last_year_complet_value") != 0,
                                           F.col("year_target_value") / F.col("last_year_complet_value") - 1).otherwise(0.0))
    unit = Window.partitionBy("year_id", "oa_branch_id", "index_asses_benchmark")  # a handful of rows
    absolute, relative = F.col("index_type") == "0", F.col("index_type") == "1"
    follows = relative & F.col("index_asses_benchmark").isin("1", "2", "4", "5")
    props = {i: safe_ratio(f"quarter_target_{i}", "year_target_value") for i in QUARTERS}
    t = t.withColumns({f"quarter_target_prop_{i}": p for i, p in props.items()})
    profile = {i: F.max(F.when(absolute, F.col(f"quarter_target_prop_{i}"))).over(unit) for i in QUARTERS}
    t = t.withColumns({f"__p{i}": p for i, p in profile.items()})
    has = F.col("__p1").isNotNull()
    t = t.withColumns({f"quarter_target_{i}": F.when(follows & has, F.col("year_target_value") * nz(f"__p{i}") * 4)
                       .otherwise(F.col(f"quarter_target_{i}")) for i in QUARTERS})
    filed = F.round("target_growth_rate", 6) == F.round("growth_rate", 6)
    for i in QUARTERS:
        filed = filed & (F.round(f"quarter_target_rate_{i}", 6) == F.round(f"quarter_target_prop_{i}", 6))
    total = sum((F.col(f"quarter_target_{i}") for i in QUARTERS[1:]), F.col("quarter_target_1"))
    adds_up = F.round(total, 4) == F.round("year_target_value", 4)
    return t.withColumn("check_result", F.when((absolute & filed) | (relative & adds_up), "1").otherwise("0")).drop(
        *[f"__p{i}" for i in QUARTERS])


def target_book(book: DataFrame, checked: DataFrame) -> DataFrame:
    """The target book after adding newly passed targets and refreshing the values of known ones."""
    passed = checked.filter((F.col("check_result") == "1") & (F.col("index_status") == "1"))
    values = ["year_target_value", *[f"quarter_target_{i}" for i in QUARTERS]]
    grown = insert_missing(book, passed, TARGET_KEYS)
    return merge_update(grown, passed.select(*TARGET_KEYS, *values), TARGET_KEYS, values)


def target_completion(targets: DataFrame, monthly: DataFrame) -> DataFrame:
    """Month, quarter-to-date and year-to-date values of each target, and completion rates.

    Values of share indicators are averaged over the months so far, others added up.
    """
    year, month = F.substring("period", 1, 4), F.col("period")
    facts = monthly.select(F.col("org_id").alias("oa_branch_id"), "busi_type", year.alias("year_id"), month.alias("busi_month"),
                           quarter_of_month(month).alias("quarter_id"), F.col("value").alias("index_value_branch"),
                           F.col("industry").alias("index_value_indust"))
    j = _with_code(targets).join(facts, ["year_id", "oa_branch_id", "busi_type"])
    upto = lambda *extra: Window.partitionBy(*TARGET_KEYS, *extra).orderBy("busi_month")  # noqa: E731 - 12 rows
    share = F.col("index_type") == "1"

    def to_date(w) -> Column:
        v = F.col("index_value_branch")
        return F.when(share, F.round(F.avg(v).over(w), 12)).otherwise(F.round(F.sum(v).over(w), 4))

    quarter_target = sum((F.when(F.col("quarter_id") == str(i), F.col(f"quarter_target_{i}")).otherwise(0.0) for i in QUARTERS[1:]),
                         F.when(F.col("quarter_id") == "1", F.col("quarter_target_1")).otherwise(0.0))
    out = j.withColumns({"quarter_value": to_date(upto("quarter_id")), "year_value": to_date(upto()), "quarter_target": quarter_target})
    return out.select(*TARGET_KEYS, "busi_type", "busi_month", "quarter_id", "index_value_branch", "index_value_indust",
                      "quarter_value", "year_value", "quarter_target", "year_target_value",
                      share_pct("quarter_value", "quarter_target").alias("quarter_rate"),
                      share_pct("year_value", "year_target_value").alias("year_rate"))


def assessment(book: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Assessment of every target and quarter: actual, surplus carried over, achievement, score."""
    rows = F.array(*[F.struct(F.lit(str(i)).alias("quarter_id"), F.col(f"quarter_target_{i}").alias("target_value")) for i in QUARTERS])
    long = (_with_code(book).withColumn("__q", F.explode(rows))
            .select(*TARGET_KEYS, "index_asses_benchmark", "index_type", "index_name", "busi_type", "weight_rate",
                    "upper_limit_score", "__q.*"))
    facts = quarterly.select(F.substring("period", 1, 4).alias("year_id"), F.substring("period", 5, 1).alias("quarter_id"),
                             F.col("org_id").alias("oa_branch_id"), "busi_type", F.col("value").alias("actual_value"))
    j = long.join(facts, ["year_id", "quarter_id", "oa_branch_id", "busi_type"], "left").fillna(0.0, ["actual_value"])
    carried = carry_over(j, ["year_id", "oa_branch_id", "index_id", "index_asses_benchmark", "index_type"])
    rate = safe_ratio("completed", "target_value")
    return carried.withColumn("complet_achievement_rate", rate).withColumn(
        "get_score", capped_score("complet_achievement_rate", "weight_rate", "upper_limit_score"))


def completion_by_indicator(assessed: DataFrame, units: DataFrame, periods: DataFrame, level: str = "unit",
                            grain: str = "quarter", indicators: Sequence[tuple] = INDICATORS) -> DataFrame:
    """Completed value and rate of every indicator per organisation and year (and quarter).

    Every organisation and indicator has a row for each of ``periods`` (``year_id`` and, by
    quarter, ``quarter_id``: a short frame taken from the calendar), empty where nothing is known.
    """
    key = LEVELS[level]
    dates = ["year_id"] + (["quarter_id"] if grain == "quarter" else [])
    if level == "unit":
        orgs = units.filter(F.col("canceled").isNull()).select(F.col("departmentid").alias("org_id"))
        rows = assessed.withColumnRenamed("oa_branch_id", "org_id")
    else:
        members = units.filter(F.col(key).isNotNull()).select(F.col("departmentid").alias("oa_branch_id"), F.col(key).alias("org_id"))
        orgs = members.select("org_id").distinct()
        rows = assessed.join(members, "oa_branch_id")
    # Shares are far below one: they keep more places than amounts.
    total = lambda c: F.when(F.col("busi_type").isin(*SHARES), money_sum(c, 12)).otherwise(money_sum(c, 4))
    done = rows.groupBy(*dates, "org_id", "busi_type").agg(
        total("target_value").alias("target"), total("completed").alias("complete_value"))
    done = done.select(*dates, "org_id", "busi_type", "complete_value", share_pct("complete_value", "target").alias("complete_value_rate"))
    spots = scaffold(scaffold(orgs, indicators, ["busi_type", "busi_type_name"]), periods.select(*dates))
    return spots.join(done, [*dates, "org_id", "busi_type"], "left")
