"""Structured Streaming versions of ingest, dedup and hourly counts."""
