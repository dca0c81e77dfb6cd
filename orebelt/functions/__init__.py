"""Column-level helpers: names, values, dates."""
