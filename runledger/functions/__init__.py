"""Column functions: exact numbers, keys of names, dates and stages."""
