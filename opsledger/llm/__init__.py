"""Operators for preparing training text: dedup, quality, language, scoring, tokens, privacy, packing."""
