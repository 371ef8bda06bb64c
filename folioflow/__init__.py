"""Ingest research-paper metadata with Spark and prepare it for semantic search."""

__version__ = "0.1.0"
