"""Operators for large text corpora: filtering, deduplication, search, packing."""
