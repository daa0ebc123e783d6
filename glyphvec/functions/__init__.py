"""Column expressions: text cleaning, sort keys, slugs, labels and vector arithmetic."""
