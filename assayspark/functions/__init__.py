"""Column expressions: no operator here moves rows."""
