"""Operators for training-data pipelines: counting, scoring, filtering, deduplicating, packing."""
