"""Operating and client analysis for units, business lines and responsibility lines.

One ``level`` argument (``unit``, ``line``, ``respons``) serves all three organisation views.
Facts are summed per account and period before accounts and organisations are joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import BIRTH_EDGES, birth_from_id
from ..functions.dates import month_key, prev_year, year_key
from ..functions.measures import cond_count, cond_sums, growth, money_sum, nz, safe_ratio, share_pct, sums
from ..operators.calendar import one_market, period_calendar, period_key, trading_day_map
from ..operators.joins import scaffold
from ..operators.merge import merge_many
from ..operators.orgs import LEVELS, attach_org
from ..operators.ranking import top_n
from ..operators.running import running_distinct, running_totals
from .income import retained_fee

WAN, YI = 10_000, 100_000_000


@dataclass(frozen=True)
class Organisation:
    """Where accounts belong, and at which level to report."""

    accounts: DataFrame
    branch_map: DataFrame
    units: DataFrame
    level: str = "unit"

    def place(self, df: DataFrame, account_cols: Sequence[str] = ()) -> DataFrame:
        return attach_org(df, self.accounts, self.branch_map, self.units, self.level, account_cols)

    def of_unit(self, df: DataFrame, unit: str = "oa_branch_id") -> DataFrame:
        """``org_id`` for frames keyed by unit; rows outside the level drop out."""
        if self.level == "unit":
            return df.withColumn("org_id", F.col(unit))
        key = LEVELS[self.level]
        dim = self.units.filter(F.col(key).isNotNull()).select(F.col("departmentid").alias(unit), F.col(key).alias("org_id"))
        return df.join(dim, unit)


def _days(calendar: DataFrame, grain: str = "month") -> DataFrame:
    return (period_calendar(calendar, grain).filter("trade_flag = 1")
            .select("busi_date", "period", "last_trade", "trade_days"))


def per_account(facts: DataFrame, measures: Sequence[str], calendar: DataFrame, grain: str = "month") -> DataFrame:
    """Facts per account and period, with the period's trading days.

    The calendar is small enough to be broadcast, so the facts are shuffled once, after partial sums.
    """
    return facts.join(_days(calendar, grain), "busi_date").groupBy("fund_account_id", "period").agg(
        *sums(measures), F.max("trade_days").alias("trade_days"))


def _last_year(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("org_id",)) -> DataFrame:
    """The frame with each month's values of a year before as ``last_*``; a key has one row a month.

    A window over one key's months: a join of the frame with itself would compute its facts twice.
    """
    month = F.substring("period", 1, 4).cast("int") * 12 + F.substring("period", 5, 2).cast("int")
    ago = Window.partitionBy(*keys).orderBy(month).rangeBetween(-12, -12)
    known = month.isNotNull() & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.select("*", *[F.when(known, F.max(c).over(ago)).alias(f"last_{c}") for c in cols])


def opened_this_year(day: Column, opened: str = "open_date") -> Column:
    return F.col(opened).between(F.trunc(day, "year"), day)


# ---- daily ---------------------------------------------------------------------------------------

def daily_operating_analysis(sett: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Closing equity per organisation and day: existing and new clients, shares, year on year.

    The base of the comparison is the last trading day up to the same day a year earlier.
    """
    per_day = sett.groupBy("fund_account_id", "busi_date").agg(*sums(["rights"]))
    placed = org.place(per_day, ["open_date"])
    is_new = opened_this_year(F.col("busi_date"))
    day = placed.groupBy("org_id", "busi_date").agg(
        money_sum("rights").alias("total"), *cond_sums({"new": (is_new, "rights"), "stock": (~F.coalesce(is_new, F.lit(False)), "rights")}))
    back = trading_day_map(calendar).select(F.col("busi_date").alias("__y"), F.col("trade_date").alias("__base"))
    bases = one_market(calendar).select("busi_date", prev_year("busi_date").alias("__y")).join(back, "__y").select("busi_date", "__base")
    before = day.select("org_id", F.col("busi_date").alias("__base"), F.col("total").alias("last_total"))
    return (day.join(bases, "busi_date", "left").join(before, ["org_id", "__base"], "left").select(
        "busi_date", "org_id", (F.col("stock") / WAN).alias("stock_end_rights"), share_pct("stock", "total").alias("stock_end_rights_prop"),
        (F.col("new") / WAN).alias("new_end_rights"), share_pct("new", "total").alias("new_end_rights_prop"),
        (F.col("total") / WAN).alias("end_rights"), growth("total", "last_total").alias("end_rights_yoy")))


# ---- rankings ------------------------------------------------------------------------------------

# Ranking codes of the weekly client report.
SETTLEMENT_RANKS = {"1": ("fund_in", "desc"), "2": ("fund_out", "desc"), "3": ("today_profit", "desc"),
                    "4": ("today_profit", "asc"), "5": ("remain_transfee", "desc")}
TRADE_RANKS = {"6": ("done_amt", "desc"), "7": ("done_sum", "desc")}


def top_clients(sett: DataFrame, trades: DataFrame, org: Organisation, n: int = 9, grain: str = "week") -> DataFrame:
    """The first ``n`` clients of every organisation and week by seven measures, ties included."""
    keys = ["fund_account_id", period_key(grain).alias("period")]

    def ranked(facts: DataFrame, aggs: list[Column], metrics) -> DataFrame:
        placed = org.place(facts.groupBy(*keys).agg(*aggs), ["client_name"])
        return top_n(placed, ["period", "org_id"], metrics, n, ["fund_account_id", "client_name"])

    funds = ranked(sett, [*sums(["fund_in", "fund_out", "today_profit"]), money_sum(retained_fee()).alias("remain_transfee")], SETTLEMENT_RANKS)
    return funds.unionByName(ranked(trades, sums(["done_amt", "done_sum"]), TRADE_RANKS))


def product_ranking(trades: DataFrame, securities: DataFrame, org: Organisation, grain: str = "month") -> DataFrame:
    """Traded products of every organisation and month with their rank by volume and turnover."""
    per = trades.groupBy("fund_account_id", period_key(grain).alias("period"), "security_id").agg(*sums(["done_amt", "done_sum"]))
    by_product = (per.join(securities.select("security_id", "product_id"), "security_id")
                  .groupBy("fund_account_id", "period", "product_id").agg(*sums(["done_amt", "done_sum"])))
    rows = org.place(by_product).groupBy("period", "org_id", "product_id").agg(*sums(["done_amt", "done_sum"]))
    # A window here holds one row per listed product, a few hundred at most.
    return rows.selectExpr(
        "period", "org_id", "product_id", f"done_amt / {WAN} AS done_amount", f"done_sum / {YI} AS done_money",
        *[f"rank() OVER (PARTITION BY period, org_id ORDER BY {c} DESC) AS {n}"
          for c, n in (("done_amt", "rank_done_amount"), ("done_sum", "rank_done_money"))])


# ---- monthly families ------------------------------------------------------------------------------

# Opened in the year of ``period`` (a month) up to the month's end; never NULL.
NEW_IN_MONTH = ("coalesce(year(open_date) = CAST(substring(period, 1, 4) AS INT) "
                "AND year(open_date) * 100 + month(open_date) <= CAST(period AS INT), false)")


def since_january(placed: DataFrame, measures: Sequence[str], calendar: DataFrame) -> DataFrame:
    """Sums since January per organisation and month: ``ytd_*``, ``ytd_*_new`` and the trading days of the time, ``ytd_days``.

    A client is new to a month if opened in its year up to its end. A row counts as new from its own month on, or from the
    opening month if that is later.
    """
    since = ("CASE WHEN year(open_date) = CAST(substring(period, 1, 4) AS INT) "
             "THEN greatest(period, date_format(open_date, 'yyyyMM')) END AS __since")
    parts = placed.selectExpr("org_id", "period", since, *measures).groupBy("org_id", "period", "__since").agg(*sums(measures))
    both = parts.selectExpr("org_id", "period", *[f"{m} AS ytd_{m}" for m in measures], *[f"0D AS ytd_{m}_new" for m in measures]).unionAll(
        parts.filter("__since IS NOT NULL").selectExpr("org_id", "__since AS period", *[f"0D AS ytd_{m}" for m in measures], *[f"{m} AS ytd_{m}_new" for m in measures]))
    names = [f"ytd_{m}{s}" for m in measures for s in ("", "_new")]
    year = Window.partitionBy("org_id", F.substring("period", 1, 4)).orderBy("period")  # twelve rows
    out = both.groupBy("org_id", "period").agg(*sums(names)).select(
        "org_id", "period", *[F.round(F.sum(n).over(year), 2).alias(n) for n in names])
    own_year = Window.partitionBy(F.substring("period", 1, 4)).orderBy("period")
    days = _days(calendar).select("period", "trade_days").distinct().select("period", F.sum("trade_days").over(own_year).alias("ytd_days"))
    return out.join(days, "period", "left")


def equity_analysis(sett: DataFrame, org: Organisation, calendar: DataFrame, deductions: DataFrame | None = None) -> DataFrame:
    """Average equity, year on year; net of own-fund deductions; split by new and existing clients since January.

    ``deductions`` has ``period, oa_branch_id, deduction``.
    """
    placed = org.place(per_account(sett, ["rights"], calendar), ["open_date"])
    m = placed.groupBy("org_id", "period").agg(money_sum("rights").alias("rights"), F.max("trade_days").alias("days"))
    if deductions is None:
        m = m.withColumn("cut", F.lit(0.0))
    else:
        cuts = org.of_unit(deductions).groupBy("org_id", "period").agg(money_sum("deduction").alias("cut"))
        m = m.join(cuts, ["org_id", "period"], "left").fillna(0.0, ["cut"])
    m = m.withColumn("avg", safe_ratio("rights", "days")).withColumn("assess", F.col("avg") - F.col("cut"))
    y = (_last_year(m, ["avg", "assess"]).join(since_january(placed, ["rights"], calendar), ["org_id", "period"])
         .withColumn("stock", F.col("ytd_rights") - F.col("ytd_rights_new")))
    return y.select("org_id", "period", (F.col("avg") / WAN).alias("avg_rights"), growth("avg", "last_avg").alias("avg_rights_yoy"),
                    (F.col("assess") / WAN).alias("assess_avg_rights"), growth("assess", "last_assess").alias("assess_avg_rights_yoy"),
                    (safe_ratio("stock", "ytd_days") / WAN).alias("avg_rights_stock"), share_pct("stock", "ytd_rights").alias("avg_rights_stock_prop"),
                    (safe_ratio("ytd_rights_new", "ytd_days") / WAN).alias("avg_rights_new"),
                    share_pct("ytd_rights_new", "ytd_rights").alias("avg_rights_new_prop"))


def turnover_analysis(trades: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Volume and turnover with year on year; split by new and existing clients since January."""
    measures = ["done_amt", "done_sum"]
    placed = org.place(per_account(trades, measures, calendar), ["open_date"])
    m = placed.groupBy("org_id", "period").agg(*sums(measures))
    y = _last_year(m, measures).join(since_january(placed, measures, calendar), ["org_id", "period"]).selectExpr(
        "*", "ytd_done_amt_new AS amt_new", "round(ytd_done_amt - ytd_done_amt_new, 2) AS amt_stock",
        "ytd_done_sum_new AS sum_new", "round(ytd_done_sum - ytd_done_sum_new, 2) AS sum_stock")
    return y.select("org_id", "period", (F.col("done_amt") / WAN).alias("done_amount"), growth("done_amt", "last_done_amt").alias("done_amount_yoy"),
                    (F.col("done_sum") / YI).alias("done_money"), growth("done_sum", "last_done_sum").alias("done_money_yoy"),
                    *[x for part in ("stock", "new") for x in (
                        (F.col(f"amt_{part}") / WAN).alias(f"done_amount_{part}"), share_pct(f"amt_{part}", "ytd_done_amt").alias(f"done_amount_{part}_prop"),
                        (F.col(f"sum_{part}") / WAN).alias(f"done_money_{part}"), share_pct(f"sum_{part}", "ytd_done_sum").alias(f"done_money_{part}_prop"))])


def client_counts(trades: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Clients opened so far, opened in the month, and active since January, with year on year."""
    opened = org.place(org.accounts.select("fund_account_id"), ["open_date"])
    by_month = opened.groupBy("org_id", month_key("open_date").alias("period")).agg(F.count(F.lit(1)).alias("opened"))
    # Months of the calendar: counts are carried through months in which nobody opened.
    months = one_market(calendar).select(month_key("busi_date").alias("period")).distinct()
    # An active client is counted in its first active month of a year, and carried to the year's end.
    first = trades.select("fund_account_id", month_key("busi_date").alias("period")).groupBy(
        "fund_account_id", F.substring("period", 1, 4).alias("year")).agg(F.min("period").alias("period"))
    active = org.place(first.select("fund_account_id", "period")).groupBy("org_id", "period").agg(F.count(F.lit(1)).alias("active"))
    spots = scaffold(opened.select("org_id").distinct(), months)
    history = Window.partitionBy("org_id").orderBy("period")  # one row per month
    m = (spots.join(by_month, ["org_id", "period"], "left").join(active, ["org_id", "period"], "left").fillna(0, ["opened", "active"])
         .withColumn("total", F.sum("opened").over(history))
         .withColumn("active", F.sum("active").over(Window.partitionBy("org_id", F.substring("period", 1, 4)).orderBy("period"))))
    y = _last_year(m, ["total", "opened", "active"])
    return y.select("org_id", "period", F.col("total").alias("total_client_num"), growth("total", "last_total").alias("total_client_num_yoy"),
                    F.col("opened").alias("new_client_num"), growth("opened", "last_opened").alias("new_client_num_yoy"),
                    F.col("active").alias("total_active_num"), growth("active", "last_active").alias("total_active_num_yoy"))


INCOME_PARTS = ("remain_transfee", "market_reduct", "interest_income")


def income_mix(brokerage: DataFrame, org: Organisation) -> DataFrame:
    """Brokerage income since January and its parts, each split by new and existing clients."""
    rows = brokerage.select("fund_account_id", F.col("busi_month").alias("period"), *INCOME_PARTS, "feature_income_total")
    placed = org.place(rows, ["open_date"])
    new, old = NEW_IN_MONTH, f"NOT {NEW_IN_MONTH}"
    cols = [*INCOME_PARTS, "feature_income_total"]
    m = placed.groupBy("org_id", "period").agg(
        *sums(cols, 4), *cond_sums({f"{c}_new": (new, c) for c in INCOME_PARTS}, 4), *cond_sums({f"{c}_stock": (old, c) for c in INCOME_PARTS}, 4))
    year = Window.partitionBy("org_id", F.substring("period", 1, 4)).orderBy("period")  # twelve rows
    m = m.select("org_id", "period", *[F.round(F.sum(c).over(year), 4).alias(c) for c in m.columns if c not in ("org_id", "period")])

    def prop(n: str, d: str) -> Column:
        return F.when(F.col(d) > 0, F.col(n) / F.col(d) * 100).otherwise(0.0)

    return m.select("org_id", "period", (F.col("feature_income_total") / WAN).alias("future_income"),
                    *[x for c in INCOME_PARTS for x in (
                        (F.col(c) / WAN).alias(f"{c}_income"), prop(c, "feature_income_total").alias(f"{c}_prop"),
                        prop(f"{c}_stock", c).alias(f"{c}_stock_prop"), prop(f"{c}_new", c).alias(f"{c}_new_prop"))])


def finance_analysis(statement: DataFrame, book_units: DataFrame, org: Organisation) -> DataFrame:
    """Assessed revenue and profit with year on year, from the profit statement."""
    rows = org.of_unit(statement.select(F.col("month_id").alias("period"), "book_id", "f5", "f21").join(book_units, "book_id"))
    m = rows.groupBy("org_id", "period").agg(money_sum("f5").alias("income"), money_sum("f21").alias("profit"))
    y = _last_year(m, ["income", "profit"])
    return y.select("org_id", "period", *[x for c in ("income", "profit") for x in (
        (F.col(c) / WAN).alias(f"assess_{c}"), growth(c, f"last_{c}").alias(f"assess_{c}_yoy"))])


def market_share(sett: DataFrame, trades: DataFrame, industry: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Shares of the market, per ten thousand. The market's volume is single-sided, in ten thousandths."""
    client_fee = nz("transfee") + nz("delivery_transfee") + nz("strikefee")
    own = org.place(per_account(sett.withColumn("fee", client_fee), ["rights", "fee"], calendar)).groupBy("org_id", "period").agg(
        *sums(["rights", "fee"]), F.max("trade_days").alias("days"))
    done = org.place(per_account(trades, ["done_amt", "done_sum"], calendar)).groupBy("org_id", "period").agg(*sums(["done_amt", "done_sum"]))
    market = industry.groupBy(F.col("busi_month").alias("period")).agg(
        (money_sum("fee", 6) * YI).alias("all_fee"), (money_sum("rights", 6) * YI).alias("all_rights"),
        (money_sum("turnover", 6) * 2 * YI).alias("all_turnover"), (money_sum("volume", 6) * 2).alias("all_volume"))
    j = own.join(done, ["org_id", "period"], "left").join(market, "period", "left")
    return j.select("org_id", "period",
                    (safe_ratio(safe_ratio("rights", "days"), safe_ratio("all_rights", "days")) * 10000).alias("avg_rights_market_rate"),
                    (safe_ratio("fee", "all_fee") * 10000).alias("futu_trans_income_market_rate"),
                    (safe_ratio("done_sum", "all_turnover") * 10000).alias("done_money_market_rate"),
                    (safe_ratio("done_amt", "all_volume") * 10000).alias("done_amount_market_rate"))


def year_to_date(df: DataFrame, value: Column, name: str, org: Organisation, spots: DataFrame, scale: int = 6) -> DataFrame:
    """``name`` at every organisation and month of ``spots``, summed since January; ``df`` has period and unit."""
    return running_totals({name: (org.of_unit(df), value, "year", scale)}, spots, ["org_id"])


def side_business(org: Organisation, spots: DataFrame, sales: DataFrame, advisory: DataFrame, options: DataFrame,
                  cooperation: DataFrame, residents: DataFrame, coop_income: DataFrame, resident_income: DataFrame,
                  tracking: DataFrame, discounts: DataFrame) -> DataFrame:
    """Product sales, advice, introducing brokers, over-the-counter options and own funds.

    All frames carry ``period`` and ``oa_branch_id``. Sales, advice, options and own funds count
    since January, projects once a year (held shares since ever), also in months without any; introducing-broker figures are the
    month's own, their income without 6 % tax. Amounts in ten thousands.
    """
    fee = F.col("invest_total_service_fee") * F.col("kernel_total_rate") * F.col("alloca_kernel_rate")
    kind = F.col("alloca_oa_branch_type")
    sold, advised, otc, own = (org.of_unit(df) for df in (sales, advisory, options, tracking))
    totals = running_totals({
        "product_sales_stock": (sold, "confirm_share", "ever", 2),
        "product_sales_new": (sold, F.when(F.col("wh_trade_type").isin("0", "1"), F.col("confirm_share")), "year", 6),
        "trade_zx_income": (advised, F.when(kind.isin("0", "1"), fee), "year", 6),
        "trade_zx_xc_income": (advised, F.when(kind == "1", fee), "year", 6),
        "off_site_princi": (otc, "notional_principal", "year", 6), "off_site_option": (otc, "total_absolute_royalty", "year", 6),
        "off_site_income": (otc, "collaborative_income", "year", 6), "own_funds_income": (own, "synergistic_revenue", "year", 6),
        "own_funds_end_rights": (own, "ending_interest", "year", 2),
        "own_funds_discounts": (org.of_unit(discounts), "depart_real_allocation_right", "year", 2)}, spots, ["org_id"])
    projects = running_distinct(own, "project_name", "own_funds_nums", spots, ["org_id"])

    def monthly(df: DataFrame, value: str, name: str) -> DataFrame:
        return org.of_unit(df).groupBy("org_id", "period").agg(money_sum(value, 6).alias(name))

    amounts = [c for c in totals.columns if c not in ("org_id", "period")]
    m = merge_many(spots, [
        (totals, amounts), (projects, ["own_funds_nums"]),
        (monthly(cooperation, "avg_rights", "__c"), ["__c"]), (monthly(residents, "avg_rights", "__r"), ["__r"]),
        (monthly(coop_income, "xt_income", "__ci"), ["__ci"]), (monthly(resident_income, "zd_income", "__ri"), ["__ri"])],
        ["org_id", "period"], default=0.0)
    return m.select("org_id", "period", *[(F.col(c) / WAN).alias(f"xt_{c}") for c in amounts], F.col("own_funds_nums").alias("xt_own_funds_nums"),
                    ((F.col("__c") + F.col("__r")) / WAN).alias("xt_colla_avg_rights"),
                    ((F.col("__ci") + F.col("__ri")) / 1.06 / WAN).alias("xt_colla_income"))


def revenue_mix(mix: DataFrame, side: DataFrame, product_income: DataFrame, option_income: DataFrame) -> DataFrame:
    """Operating income (ten thousands) and what brokerage, advice, products, options and own funds make of it.

    ``product_income`` has ``org_id, period, product_sell_income`` and ``option_income`` has ``org_id, period,
    option_income``, the options' total income, both in ten thousands and since January.
    """
    j = (side.join(mix.select("org_id", "period", "future_income"), ["org_id", "period"], "left")
         .join(product_income, ["org_id", "period"], "left").join(option_income, ["org_id", "period"], "left").fillna(0.0))
    parts = {"future_income": "future_income", "trade_zx_income": "xt_trade_zx_income", "product_xc_income": "product_sell_income",
             "over_option_income": "option_income", "own_funds_income": "xt_own_funds_income"}
    total = sum((F.col(c) for c in list(parts.values())[1:]), F.col("future_income"))
    return j.withColumn("operat_income", total).select(
        "org_id", "period", "operat_income", *[share_pct(c, "operat_income").alias(f"{n}_prop") for n, c in parts.items()])


def monthly_operating_analysis(spots: DataFrame, families: Sequence[DataFrame]) -> DataFrame:
    """All families on one row per organisation and month (``spots``), in one pass."""
    keys = ["org_id", "period"]
    return merge_many(spots, [(df, [c for c in df.columns if c not in keys]) for df in families], keys)


# ---- clients ---------------------------------------------------------------------------------------

CLIENT_TYPES: Mapping[str, tuple[str, ...]] = {"0": ("0",), "1": ("1",), "3": ("3", "4")}


def client_type_mix(per: DataFrame, org: Organisation, measure: str, prefix: str) -> DataFrame:
    """Share of each client type in ``measure`` per organisation and month, with year on year.

    ``per`` has one row per account and period. Averages over the month's days cancel out in the
    shares, so plain sums are enough.
    """
    placed = org.place(per, ["client_type"])
    kinds = {t: f"client_type IN ({', '.join(repr(c) for c in codes)})" for t, codes in CLIENT_TYPES.items()}
    m = placed.groupBy("org_id", "period").agg(
        money_sum(measure, 4).alias("__all"), *cond_sums({f"__{t}": (cond, measure) for t, cond in kinds.items()}, 4))
    m = m.select("org_id", "period", *[share_pct(f"__{t}", "__all").alias(f"{prefix}_{t}") for t in kinds])
    y = _last_year(m, [f"{prefix}_{t}" for t in kinds])
    return y.select("org_id", "period", *[x for t in kinds for x in (
        F.col(f"{prefix}_{t}"), growth(f"{prefix}_{t}", f"last_{prefix}_{t}").alias(f"{prefix}_{t}_yoy"))])


def new_client_type_mix(per: DataFrame, org: Organisation, measure: str, prefix: str) -> DataFrame:
    """The same shares among clients opened this year."""
    placed = org.place(per, ["client_type", "open_date"]).filter(F.expr(NEW_IN_MONTH))
    kinds = {t: f"client_type IN ({', '.join(repr(c) for c in codes)})" for t, codes in CLIENT_TYPES.items()}
    m = placed.groupBy("org_id", "period").agg(
        money_sum(measure, 4).alias("__all"), *cond_sums({f"__{t}": (cond, measure) for t, cond in kinds.items()}, 4))
    return m.select("org_id", "period", *[share_pct(f"__{t}", "__all").alias(f"{prefix}_{t}") for t in kinds])


def equity_increment(sett: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Yearly increment of average equity: this year's new clients, and the change of older ones.

    Averages run over the year's trading days; older clients are compared with all clients of the
    year before. In ten thousands.
    """
    placed = org.place(per_account(sett, ["rights"], calendar, "year"), ["open_date"])
    new = year_key("open_date") == F.col("period")
    m = placed.groupBy("org_id", "period").agg(
        money_sum("rights").alias("all"), *cond_sums({"new": (new, "rights"), "old": (year_key("open_date") < F.col("period"), "rights")}),
        F.max("trade_days").alias("days"))
    m = m.select("org_id", "period", *[safe_ratio(c, "days").alias(c) for c in ("all", "new", "old")])
    last = m.select("org_id", (F.col("period").cast("int") + 1).cast("string").alias("period"), F.col("all").alias("last_all"))
    return m.join(last, ["org_id", "period"], "left").select(
        "org_id", "period", (F.col("new") / WAN).alias("rights_add_new"), ((F.col("old") - nz("last_all")) / WAN).alias("rights_add_old"))


def age_structure(trades: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Traded clients per month by decade of birth, all and those opened this year.

    New clients are counted when they traded in the year up to the month.
    """
    traded = trades.select("fund_account_id", month_key("busi_date").alias("period")).distinct()
    placed = org.place(traded, ["open_date", "id_no"]).withColumn("birth", birth_from_id("id_no"))
    edges = [F.lit(e).cast("date") for e in BIRTH_EDGES]
    b = F.col("birth")
    bands = {"60": b <= edges[0], "70": (b > edges[0]) & (b <= edges[1]), "80": (b > edges[1]) & (b <= edges[2]),
             "90": (b > edges[2]) & (b <= edges[3]), "00": b > edges[3]}
    monthly = placed.groupBy("org_id", "period").agg(*[cond_count(c).alias(f"age_{n}") for n, c in bands.items()])
    # A new client counts from its first traded month of the opening year on.
    opened = year_key("open_date")
    first = (placed.filter((F.substring("period", 1, 4) == opened) & F.expr(NEW_IN_MONTH))
             .groupBy("org_id", "fund_account_id", "birth").agg(F.min("period").alias("period"))
             .groupBy("org_id", "period").agg(*[cond_count(c).alias(f"__{n}") for n, c in bands.items()]))
    year = Window.partitionBy("org_id", F.substring("period", 1, 4)).orderBy("period")  # twelve rows
    return monthly.join(first, ["org_id", "period"], "left").fillna(0).select(
        "org_id", "period", *[f"age_{n}" for n in bands], *[F.sum(f"__{n}").over(year).alias(f"age_{n}_new") for n in bands])


def label_cohorts(labels: DataFrame, sett: DataFrame, trades: DataFrame, contributions: DataFrame, org: Organisation,
                  calendar: DataFrame) -> DataFrame:
    """Clients carrying a label in a month: number, average equity, volume, turnover, contribution.

    ``labels`` has ``label_id, fund_account_id, period``; contributions are per account and period.
    """
    keys = ["fund_account_id", "period"]
    months = _days(calendar).groupBy("period").agg(F.max("trade_days").alias("days"))
    tagged = labels.select("label_id", *keys).distinct()
    equity = per_account(sett, ["rights"], calendar).drop("trade_days")
    done = per_account(trades, ["done_amt", "done_sum"], calendar).drop("trade_days")
    rows = tagged.join(equity, keys, "left").join(done, keys, "left").join(contributions, keys, "left")
    m = org.place(rows).groupBy("label_id", "org_id", "period").agg(
        F.count(F.lit(1)).alias("client_num"), *sums(["rights", "done_amt", "done_sum", "jgx"]))
    return m.join(months, "period").select(
        "label_id", "org_id", "period", "client_num", (safe_ratio("rights", "days") / YI).alias("avg_rights"),
        (F.col("done_amt") / WAN).alias("done_amount"), (F.col("done_sum") / YI).alias("done_money"), (F.col("jgx") / WAN).alias("net_contribution"))


# ---- brokerage income and equity summary -------------------------------------------------------------

def brokerage_summary(spots: DataFrame, lines: DataFrame, advisory: DataFrame, options: DataFrame, sett: DataFrame,
                      sales: DataFrame, cooperation: DataFrame, residents: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """Monthly income and equity of every unit: ledger income, advice, options, equity, products, introducing brokers."""
    keys = ["org_id", "period"]
    ledger = org.of_unit(lines).groupBy(*keys).agg(
        money_sum("b6").alias("remain_transfee_income"), money_sum("b8").alias("market_reduce_income"), money_sum("b7").alias("clear_interest_income"))
    fee, kind = F.col("invest_total_service_fee"), F.col("alloca_oa_branch_type")
    advice = org.of_unit(advisory).groupBy(*keys).agg(
        money_sum(fee).alias("trans_consult_income"),
        money_sum(F.when(kind == "1", fee * F.col("kernel_total_rate") * F.col("alloca_kernel_rate")), 6).alias("sales_income"))
    otc = org.of_unit(options).groupBy(*keys).agg(
        money_sum("total_income").alias("out_option_income"), *sums(["notional_principal"]), money_sum("total_absolute_royalty").alias("royalty"))
    last = _days(calendar).filter(F.col("busi_date") == F.col("last_trade")).select("busi_date", "period")
    per = sett.groupBy("fund_account_id", "busi_date").agg(*sums(["rights"])).join(last, "busi_date")
    closing = org.place(per).groupBy(*keys).agg(money_sum("rights").alias("end_rights"))
    stock = org.of_unit(sales).groupBy(*keys).agg(
        money_sum("confirm_share").alias("product_inventory"),
        money_sum(F.when(F.col("wh_trade_type").isin("0", "1"), F.col("confirm_share"))).alias("product_new"))
    both = org.of_unit(cooperation.select("period", "oa_branch_id", "end_rights", "avg_rights").unionByName(
        residents.select("period", "oa_branch_id", "end_rights", "avg_rights"))).groupBy(*keys).agg(
        money_sum("end_rights", 6).alias("ib_end_rights"), money_sum("avg_rights", 6).alias("ib_avg_rights"))
    m = merge_many(spots, [(df, [c for c in df.columns if c not in keys]) for df in (ledger, advice, otc, closing, stock, both)], keys, default=0.0)
    return m.withColumn("futu_income", F.round(F.col("remain_transfee_income") + F.col("market_reduce_income") + F.col("clear_interest_income"), 2))
