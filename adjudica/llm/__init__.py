"""Operators of a training-data pipeline: sharding, tokens, deduplication, filters, packing and search."""
