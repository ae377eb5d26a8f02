"""Layered analytics on plain Parquet, written as DataFrame-to-DataFrame functions."""
