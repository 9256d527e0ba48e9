"""Relational operators of the ingest, quality and reporting paths."""
