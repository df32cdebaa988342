"""Operators for preparing text collections: search, filters, deduplication, mixing, packing."""
