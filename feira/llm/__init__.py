"""Operators that prepare training data: archives, filters, deduplication, scoring and token output."""
