"""The dashboard queries (Q01-Q40) and their registry."""
