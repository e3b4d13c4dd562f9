"""Operators for preparing training data: filters, duplicates, scoring, search, tokens."""
