"""Structured Streaming ingest of ticks."""
