"""Column expressions: dates, amounts, codes, splits, and text-to-type rules."""
