"""Column expressions: cleaners, measures and schema names."""
