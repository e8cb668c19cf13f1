"""Column expressions and declared types."""
