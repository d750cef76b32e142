"""Operators of a training-data pipeline: quality, mixing, scoring, deduplication, extraction."""
