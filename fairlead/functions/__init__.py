"""Column functions: text, dates, taxonomy, identity."""
