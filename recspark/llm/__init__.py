"""Operators of a training-data pipeline: quality, extraction, packing, tokens, near-duplicates."""
