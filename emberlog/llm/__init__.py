"""Operators for preparing training text: deduplication, formatting, tokens, filters."""
