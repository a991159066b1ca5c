"""Key-client programme: composition, retention, contribution and growth of a tagged cohort."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import BAND_LABELS, BIRTH_EDGES, OPEN_EDGES, birth_from_id
from ..functions.dates import year_key
from ..functions.measures import bucketize, cond_count, cond_sum, money_sum, nz, safe_ratio, sums
from ..operators.calendar import one_market
from .analysis import CLIENT_TYPES, Organisation

# Parts of a client's net contribution, added and subtracted.
ADDED = ("subsistence_fee_amt", "int_amt", "exchangeret_amt", "oth_amt")
SUBTRACTED = ("fd_amt", "i_int_amt", "i_exchangeret_amt", "broker_amt", "soft_amt", "i_oth_amt", "broker_int_amt",
              "broker_eret_amt", "staff_amt", "staff_int_amt", "staff_eret_amt")


def net_contribution(values: DataFrame, period: Column, overrides: DataFrame | None = None) -> DataFrame:
    """``fund_account_id, period, jgx``: what an account brought in, net of rebates and commissions.

    ``overrides`` (per account and day) replaces the staff commissions where it has a value.
    Columns the source lacks count as zero.
    """
    df = values
    if overrides is not None:
        o = overrides.groupBy("fund_account_id", "busi_date").agg(
            F.sum("ib_amt").alias("__ib"), F.sum("staff_int_amt").alias("__si"))
        df = df.join(o, ["fund_account_id", "busi_date"], "left")
        for name, new in (("staff_amt", "__ib"), ("staff_int_amt", "__si")):
            old = F.col(name) if name in df.columns else F.lit(0.0)
            df = df.withColumn(name, F.coalesce(F.col(new), old))
    zero = F.lit(0.0)
    plus = sum((nz(c) for c in ADDED if c in df.columns), zero)
    minus = sum((nz(c) for c in SUBTRACTED if c in df.columns), zero)
    return df.groupBy("fund_account_id", period.alias("period")).agg(money_sum(plus - minus).alias("jgx"))


def key_client_programme(members: DataFrame, sett: DataFrame, contributions: DataFrame, org: Organisation, calendar: DataFrame) -> DataFrame:
    """One row per organisation and year for the tagged clients of ``members`` (account, year).

    Each member-year meets its neighbour year once: a member row says whether the account was also
    a member the year before, and a row of last year's members says whether it stayed. All counts,
    contributions and growth rates are then conditional sums of one grouping.

    Numbers 1 to 4 split this year's members: also last year (all / opened this year) and new
    (older account / opened this year). ``lost_*`` are last year's members who left.
    """
    acct = ["fund_account_id", "period"]
    m = members.select(*acct).distinct()
    jgx = contributions.select(*acct, "jgx")
    # A row per account and year in which it is a member now, was one last year, or both.
    nxt = m.select("fund_account_id", (F.col("period").cast("int") + 1).cast("string").alias("period"))
    marks = (m.select(*acct, F.lit(1).alias("now"), F.lit(0).alias("was"))
             .unionByName(nxt.select(*acct, F.lit(0).alias("now"), F.lit(1).alias("was")))
             .groupBy(*acct).agg(F.max("now").alias("now"), F.max("was").alias("was")))
    years = m.select("period").distinct()
    marks = marks.join(years, "period", "left_semi")
    last = jgx.select("fund_account_id", (F.col("period").cast("int") + 1).cast("string").alias("period"), F.col("jgx").alias("last_jgx"))
    days = (one_market(calendar).filter("trade_flag = 1").select("busi_date", year_key("busi_date").alias("period")))
    counts = days.groupBy("period").agg(F.count(F.lit(1)).alias("days"))
    fee = nz("transfee") + nz("delivery_transfee") + nz("strikefee")
    flows = sett.join(days, "busi_date").groupBy(*acct).agg(*sums(["rights"]), money_sum(fee).alias("fee"))
    rows = (marks.join(jgx, acct, "left").join(last, acct, "left").join(flows, acct, "left").fillna(0.0, ["jgx", "last_jgx", "rights", "fee"]))
    placed = org.place(rows, ["client_type", "open_date"]).join(counts, "period")

    now, was = "now = 1", "was = 1"
    kept, fresh, lost = "now = 1 AND was = 1", "now = 1 AND was = 0", "now = 0 AND was = 1"
    year = "CAST(period AS INT)"
    groups = {"1": kept, "2": f"{kept} AND year(open_date) = {year}", "3": f"{fresh} AND NOT year(open_date) >= {year}",
              "4": f"{fresh} AND year(open_date) >= {year}"}
    types = {t: f"now = 1 AND client_type IN ({', '.join(repr(c) for c in codes)})" for t, codes in CLIENT_TYPES.items()}
    g = placed.groupBy("org_id", "period").agg(
        cond_count(now).alias("num_all"), cond_sum(now, "jgx").alias("jgx_all"),
        *[cond_count(c).alias(f"client_num_{n}") for n, c in types.items()],
        *[cond_sum(c, v).alias(f"{v}_{n}") for v in ("jgx", "rights", "fee") for n, c in types.items()],
        cond_sum(now, "rights").alias("rights_all"), cond_sum(now, "fee").alias("fee_all"),
        *[cond_count(c).alias(f"num_{n}") for n, c in groups.items()], *[cond_sum(c, "jgx").alias(f"sum_{n}") for n, c in groups.items()],
        cond_count(was).alias("last_num"), cond_sum(was, "last_jgx").alias("last_sum"),
        cond_count(lost).alias("lost_num"), cond_sum(lost, "last_jgx").alias("lost_sum"),
        cond_sum(kept, "last_jgx").alias("kept_last_sum"), F.max("days").alias("days"))
    c = F.col

    def rate_growth(n1, d1, n0, d0) -> Column:
        base = safe_ratio(n0, d0)
        return F.when(base != 0, safe_ratio(n1, d1) / base - 1).otherwise(0.0)

    return g.select(
        "org_id", "period",
        *[x for t in types for x in (
            safe_ratio(f"rights_{t}", "days").alias(f"avg_rights_{t}"), safe_ratio(f"rights_{t}", "rights_all").alias(f"avg_rights_{t}_rate"),
            safe_ratio(f"fee_{t}", "days").alias(f"transfee_{t}"), safe_ratio(f"fee_{t}", "fee_all").alias(f"transfee_{t}_rate"),
            c(f"client_num_{t}"), (c(f"jgx_{t}") / 10000).alias(f"clear_transfee_{t}"),
            safe_ratio(f"jgx_{t}", f"client_num_{t}").alias(f"avg_clear_transfee_{t}"))],
        c("num_all").alias("qw_client_num_all"), c("jgx_all").alias("qw_clear_transfee_all"),
        (safe_ratio("jgx_all", "num_all") / 10000).alias("qw_avg_clear_transfee_all"),
        *[x for n in groups for x in (
            c(f"num_{n}").alias(f"qw_client_num_{n}"), safe_ratio(f"num_{n}", "num_all").alias(f"qw_client_num_{n}_rate"),
            c(f"sum_{n}").alias(f"qw_clear_transfee_{n}"), safe_ratio(f"sum_{n}", "jgx_all").alias(f"qw_clear_transfee_{n}_rate"),
            (safe_ratio(f"sum_{n}", f"num_{n}") / 10000).alias(f"qw_avg_clear_transfee_{n}"))],
        c("last_num").alias("lose_client_num1"), c("num_1").alias("lose_client_num2"), safe_ratio("num_1", "last_num").alias("lose_client_num3"),
        c("lost_num").alias("lose_client_num4"), safe_ratio("lost_num", "last_num").alias("lose_client_num5"),
        c("last_sum").alias("lose_client_num6"), c("sum_1").alias("lose_client_num7"), safe_ratio("sum_1", "last_sum").alias("lose_client_num8"),
        c("lost_sum").alias("lose_client_num9"), safe_ratio("lost_sum", "last_sum").alias("lose_client_num10"),
        rate_growth("jgx_all", "num_all", "last_sum", "last_num").alias("lose_client_num11"),
        rate_growth("sum_1", "num_1", "kept_last_sum", "num_1").alias("lose_client_num12"),
        F.round(c("sum_1") - c("kept_last_sum"), 2).alias("lose_client_num13"))


def opening_and_age_bands(members: DataFrame, contributions: DataFrame, org: Organisation,
                          open_edges=OPEN_EDGES, birth_edges=BIRTH_EDGES) -> DataFrame:
    """Natural persons of the cohort by opening-year and birth-decade band, with contribution.

    Contribution in ten thousands, and per client. Accounts whose identity number is unreadable
    have an empty birth band.
    """
    acct = ["fund_account_id", "period"]
    rows = members.select(*acct).distinct().join(contributions.select(*acct, "jgx"), acct, "left").fillna(0.0, ["jgx"])
    placed = org.place(rows, ["client_type", "open_date", "id_no"]).filter(F.col("client_type") == "0")
    days = lambda edges: [date.fromisoformat(e) for e in edges]
    g = placed.groupBy(
        "org_id", "period", F.coalesce(bucketize("open_date", days(open_edges), BAND_LABELS), F.lit("")).alias("open_date_flag"),
        F.coalesce(bucketize(birth_from_id("id_no"), days(birth_edges), BAND_LABELS), F.lit("")).alias("age_range")).agg(
        F.count(F.lit(1)).alias("client_num"), money_sum("jgx").alias("__jgx"))
    return g.select("org_id", "period", "open_date_flag", "age_range", "client_num", (F.col("__jgx") / 10000).alias("jgx_sum"),
                    safe_ratio("__jgx", "client_num").alias("avg_jgx"))
