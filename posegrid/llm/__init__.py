"""Operators that prepare training data: filters, near-duplicate joins, tokens and packing."""
