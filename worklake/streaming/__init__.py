"""Incremental ingest with Structured Streaming (same operators as batch)."""
