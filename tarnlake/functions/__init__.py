"""Column expressions: dates, casts, keys and text."""
