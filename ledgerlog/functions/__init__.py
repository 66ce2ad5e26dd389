"""Column expressions: time windows, text, statistics and message parsing."""
