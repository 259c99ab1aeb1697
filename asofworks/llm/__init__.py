"""Operators for large training corpora: cleaning, deduplication, mixing, search and output."""
