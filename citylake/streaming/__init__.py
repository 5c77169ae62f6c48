"""Incremental ingest with Structured Streaming around the batch functions."""
