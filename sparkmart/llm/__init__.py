"""Operators of a training-data pipeline: filters, deduplication, decontamination, tokens, shards."""
