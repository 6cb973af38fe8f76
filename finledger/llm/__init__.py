"""Operators of a training-data pipeline: quality, duplicates, leaks, toxicity, search, tokens and formats."""
