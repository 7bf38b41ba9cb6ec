"""DuckDB twins of the registered queries (the correctness gate's oracle)."""
