"""Operators for preparing training data: quality, dedup, personal data, tokens, packing, shards, search."""
