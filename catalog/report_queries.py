"""One query per report of the library, over whole tables."""

from __future__ import annotations

from catalog import reports_settlement, reports_income, reports_ledger, reports_analysis, reports_targets, reports_cohorts  # noqa: F401
