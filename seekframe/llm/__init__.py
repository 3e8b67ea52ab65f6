"""Operators that prepare training data: packing, deduplication, scans, filters and formats."""
