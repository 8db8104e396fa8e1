"""Operators for preparing training text: mixing, extraction, quality, packing, near duplicates."""
