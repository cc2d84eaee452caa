"""tickloom: market time-series analytics as plain Spark DataFrame functions."""
