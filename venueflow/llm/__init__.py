"""Operators for preparing training text: filtering, near-duplicates, private data, mixing, tokens."""
