"""Operators for preparing text corpora: scans, deduplication, search, sharding and packing."""
