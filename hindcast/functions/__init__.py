"""Column-level functions: parsing, naming, time zones, distribution quantiles."""
