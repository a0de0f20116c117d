"""Column expressions: text cleaning, privacy, keys, dates and money."""
