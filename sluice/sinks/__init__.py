"""Append, quarantine, upsert and catalog sinks."""
