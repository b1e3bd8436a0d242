"""Column expressions and parameter predicates (built-in Spark expressions only)."""
