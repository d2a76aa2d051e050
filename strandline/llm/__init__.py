"""Operators for building training corpora: dedup, filtering, sharding, mixing, tokenisation."""
