"""Column expressions: clocks, amounts, JSON payloads, words."""
