"""Column expressions: quality flags and value transforms."""
