"""Column expressions and reusable aggregate shapes."""
