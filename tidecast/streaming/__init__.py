"""Structured Streaming variants of ingest, counts, upsert and monitoring."""
