"""Column expressions: dates, text, numbers and row keys."""
