"""Operators of a training-data pipeline: deduplication, rules, personal data, archives, tokens."""
