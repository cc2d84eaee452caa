"""Reusable relational operators: dedup, series windows, as-of, upsert, checks."""
