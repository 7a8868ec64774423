"""Incremental ingest of monthly trip files with Structured Streaming."""
