"""Independent SQL formulations (DuckDB dialect) of every registered query."""
