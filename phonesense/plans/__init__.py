"""Query plans: the registered query catalog, its DuckDB oracle and the
written payload table."""
