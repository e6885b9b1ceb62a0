"""Operators of a training-data pipeline: filtering, extraction, deduplication, search,
sharding, tokens and mixing. Nothing else in the library imports this subpackage."""
