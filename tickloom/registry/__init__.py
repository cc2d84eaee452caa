"""Named queries over the test tables, with a DuckDB statement for each where SQL can express it."""
