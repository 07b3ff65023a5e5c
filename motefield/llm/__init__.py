"""Operators for preparing training text: extraction, formatting, filtering, deduplication, search and packing."""
