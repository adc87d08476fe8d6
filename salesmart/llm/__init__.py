"""Operators for preparing text corpora (deduplication, scoring, mixing, encoding)."""
