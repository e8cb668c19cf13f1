"""Operators for preparing training text: archives, tokens, duplicates, filters, mixing."""
