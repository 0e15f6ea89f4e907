"""Feed descriptions, routing, whole runs and reports."""
