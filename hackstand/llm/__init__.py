"""Operators for training-data corpora: quality, deduplication, tokens, privacy, scoring, sharding, packing."""
