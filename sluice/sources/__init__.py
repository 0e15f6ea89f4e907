"""Readers for CSV feeds, lookups and tables."""
