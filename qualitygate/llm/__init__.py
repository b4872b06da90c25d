"""Operators for preparing training text: dedup, scans, tokens, packing, quality, neighbours."""
