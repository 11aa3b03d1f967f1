"""Column expressions: casts, surrogate keys, enrichment formulas."""
