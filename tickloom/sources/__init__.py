"""Readers, ingest projections and idempotent writers."""
