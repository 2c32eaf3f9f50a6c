"""Operators for preparing training data: archives, near duplicates, tokens, packing, filters."""
