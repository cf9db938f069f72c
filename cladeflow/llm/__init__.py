"""Operators of a training-data pipeline: scoring, deduplication, filtering and mixing of documents."""
