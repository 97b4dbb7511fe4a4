"""Incremental reports over a folder of arriving clean Parquet files."""

from tarmac.streaming.incremental import clean_stream, read_published, run_incremental_report

__all__ = ["clean_stream", "read_published", "run_incremental_report"]
