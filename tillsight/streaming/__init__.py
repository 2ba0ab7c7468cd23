"""Incremental ingest of raw transaction drops (Structured Streaming)."""
