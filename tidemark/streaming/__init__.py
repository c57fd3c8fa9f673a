"""Structured Streaming twins of the batch ingest, dedup and daily-bar jobs."""
