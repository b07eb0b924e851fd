"""Sources and sinks: drifting-header CSV exports in, partitioned tables out."""

from formlens.sources.scan import Exports, header_table, read_exports, scan_exports
from formlens.sources.sink import for_csv, read_cleaned, write_cleaned
from formlens.sources.store import commit, read_manifest, read_rejected, read_store, store_report, store_summary

__all__ = [
    "Exports", "commit", "for_csv", "header_table", "read_cleaned", "read_exports", "read_manifest", "read_rejected", "read_store",
    "scan_exports", "store_report", "store_summary", "write_cleaned",
]
