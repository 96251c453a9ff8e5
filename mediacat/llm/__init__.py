"""Operators for large text corpora: search, near and exact duplicates, extraction, tokens, quality, language, packing."""
