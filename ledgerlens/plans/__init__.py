"""Whole order jobs: base, tuned (persist/repartition) and single-pass."""

from ledgerlens.plans.order_job import OrderReports, base_reports
from ledgerlens.plans.single_pass import (
    fill_value, order_stats, reports_from_stats, single_pass_reports,
)
from ledgerlens.plans.tuned import TunedReports, tuned_report, tuned_reports

__all__ = [
    "OrderReports",
    "TunedReports",
    "base_reports",
    "fill_value",
    "order_stats",
    "reports_from_stats",
    "single_pass_reports",
    "tuned_report",
    "tuned_reports",
]
