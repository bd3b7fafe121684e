"""Operators for preparing training text: packing, filters, deduplication, formatting, counts."""
