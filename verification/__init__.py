"""Independent SQL statements of the registered queries, for DuckDB."""
