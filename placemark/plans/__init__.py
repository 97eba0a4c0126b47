"""Query registry: Spark query and DuckDB oracle side by side."""
