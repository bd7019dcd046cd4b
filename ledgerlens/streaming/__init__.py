"""The order reports kept current while order-line files keep arriving."""

from ledgerlens.streaming.reports import latest_report, order_stats_stream, start_order_reports

__all__ = ["latest_report", "order_stats_stream", "start_order_reports"]
