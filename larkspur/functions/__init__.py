"""Column expressions and projections."""
