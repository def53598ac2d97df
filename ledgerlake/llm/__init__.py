"""Operators for preparing training text: dedup, fingerprints, tokenization, quality, privacy, mixing.

Nothing outside this folder imports it; ``queries`` holds the thin registered queries.
"""
