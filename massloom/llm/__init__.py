"""Operators for preparing training text: deduplication, filters, scans, tokens."""
