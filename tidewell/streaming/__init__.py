"""Structured Streaming sources, windowed aggregates, sinks and incremental state."""
