"""Readers of tables, event logs, companion logs and plain-text logs."""

from tracewright.sources.tables import cut_lineage, lookup, lookup_join, once, table

__all__ = ["cut_lineage", "lookup", "lookup_join", "once", "table"]
