"""Operators for preparing training data: filters, duplicates, quality, packing."""
