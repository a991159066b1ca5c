"""Roll-up along account -> branch -> unit -> business line / responsibility line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import sums

# Which column of the organisation table carries each level's key.
LEVELS = {"unit": "oa_branch_id", "line": "business_line_id", "respons": "respons_line_id"}


def org_dimension(branch_map: DataFrame, units: DataFrame | None, level: str) -> DataFrame:
    """``branch_id -> org_id`` at ``level``; branches that map to nothing are dropped."""
    key = LEVELS[level]
    dim = branch_map.select(F.col("ctp_branch_id").alias("branch_id"), "oa_branch_id")
    if level != "unit":
        if units is None:
            raise ValueError("line and respons levels need the unit table")
        dim = dim.join(units.select(F.col("departmentid").alias("oa_branch_id"), key), "oa_branch_id")
    return dim.filter(F.col(key).isNotNull()).select("branch_id", F.col(key).alias("org_id")).distinct()


def attach_org(df: DataFrame, accounts: DataFrame | None, branch_map: DataFrame,
               units: DataFrame | None = None, level: str = "unit",
               account_cols: Sequence[str] = (), account: str = "fund_account_id") -> DataFrame:
    """Add ``org_id`` (and chosen account columns); rows of unmapped branches drop out.

    Call it on facts already summed per account: the join then sees one row per account and
    key, however many facts a busy account has. ``accounts=None`` means that ``df`` carries
    ``branch_id`` itself.
    """
    org = org_dimension(branch_map, units, level)
    if accounts is None:
        return df.join(org, "branch_id")
    dim = (accounts.select(account, "branch_id", *[c for c in account_cols if c != "branch_id"])
           .join(org, "branch_id"))
    clashing = [c for c in ("branch_id", *account_cols) if c in df.columns and c != account]
    return df.drop(*clashing).join(dim, account)


def org_rollup(facts: DataFrame, measures: Sequence[str], accounts: DataFrame, branch_map: DataFrame,
               units: DataFrame | None = None, level: str = "unit", keys: Sequence[str] = (),
               group: dict[str, Column] | None = None, account_cols: Sequence[str] = (),
               scale: int = 2) -> DataFrame:
    """Two-stage sum: per account, then per organisation (and ``keys``, and account-based ``group``)."""
    per_account = facts.groupBy("fund_account_id", *keys).agg(*sums(measures, scale))
    placed = attach_org(per_account, accounts, branch_map, units, level, account_cols)
    group = group or {}
    return placed.groupBy("org_id", *keys, *[e.alias(n) for n, e in group.items()]).agg(
        *sums(measures, scale))
