"""Scans, sinks, catalog registration and the flight-shaped test view."""

from tarmac.sources.catalog import register_table, run_sql_file, run_sql_text, use_db
from tarmac.sources.flightview import flights_raw, read_table
from tarmac.sources.io import (
    current_run, merge_parts, read_clean, read_raw, read_runlog, require_non_empty, scratch_table, volume_label,
    write_report, write_split, write_volume,
)

__all__ = [
    "current_run", "flights_raw", "merge_parts", "read_clean", "read_raw", "read_runlog", "read_table",
    "register_table", "require_non_empty", "run_sql_file", "run_sql_text", "scratch_table", "use_db", "volume_label",
    "write_report", "write_split", "write_volume",
]
