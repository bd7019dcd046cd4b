"""Table adapters, file scans and sinks, and the distributed order generator."""

from ledgerlens.sources.tables import order_lines, read_table, run_log, run_meta, speedup_pairs

__all__ = ["order_lines", "read_table", "run_log", "run_meta", "speedup_pairs"]
