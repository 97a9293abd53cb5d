"""Operators of a training-data pipeline (toxicity, dedup, joins, search, mixing, tokens)."""
