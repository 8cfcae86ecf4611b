"""Operators for training-data pipelines: deduplication, packing, filtering, redaction and scoring of text."""
