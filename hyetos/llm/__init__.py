"""Operators for preparing training data: duplicates, contamination, packing, formats."""
