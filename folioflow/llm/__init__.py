"""Operators of a training-data pipeline: scans, models, joins, deduplication and mixing of documents."""
