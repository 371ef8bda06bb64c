"""Structured Streaming forms of the landing, the vectorization and the alarms."""
