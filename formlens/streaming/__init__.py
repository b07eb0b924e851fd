"""Incremental intake of exports with Structured Streaming (foreachBatch)."""

from formlens.streaming.intake import read_intake, read_rejected, start_intake, store_report

__all__ = ["read_intake", "read_rejected", "start_intake", "store_report"]
