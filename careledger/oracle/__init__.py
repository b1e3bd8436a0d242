"""DuckDB oracle SQL used to check every registered query."""
