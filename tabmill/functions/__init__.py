"""Column expressions and row-wise steps."""
