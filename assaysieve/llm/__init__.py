"""Operators for preparing training text: duplicates, extraction, scans, quality, tokens and languages."""
