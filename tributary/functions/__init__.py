"""Column expressions: text, numbers, dates, recoding and scoring."""
