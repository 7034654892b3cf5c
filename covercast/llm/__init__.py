"""Operators for training-data pipelines: extraction, deduplication, scoring, mixing, tokens."""
