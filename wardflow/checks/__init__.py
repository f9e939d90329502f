"""Oracle SQL (DuckDB) for the correctness gate."""
