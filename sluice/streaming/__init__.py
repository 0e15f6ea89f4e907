"""Structured Streaming ingestion and streaming upsert."""
