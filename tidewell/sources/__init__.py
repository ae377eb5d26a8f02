"""Readers and ingestion columns."""

from tidewell.sources.files import (
    bad_rows,
    parse_json,
    read_csv,
    read_json,
    read_parquet,
    stream_files,
    with_audit,
    with_constants,
)

__all__ = ["bad_rows", "parse_json", "read_csv", "read_json", "read_parquet", "stream_files", "with_audit", "with_constants"]
