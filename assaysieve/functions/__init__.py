"""Column expressions and fixed vocabulary."""
