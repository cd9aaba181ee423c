"""Column expressions: text cleaning, calendar attributes and guarded arithmetic."""
