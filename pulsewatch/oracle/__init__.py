"""DuckDB statements with the same results, written independently of the jobs."""
