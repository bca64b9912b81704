"""Operators of a training-data pipeline: sharding, quality, extraction, deduplication, packing, archives."""
