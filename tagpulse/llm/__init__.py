"""Operators for preparing training data: packing, search, extraction, deduplication, mixing, scans, scoring."""
