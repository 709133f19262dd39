"""Incremental ingest and event streams on Structured Streaming."""
