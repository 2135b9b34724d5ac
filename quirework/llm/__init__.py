"""Operators of a training-data pipeline: filters, deduplication, decontamination, mixing, sharding, chat formatting."""
