"""Operators for training data: cleaning, deduplication, mixing, sharding, tokens."""
