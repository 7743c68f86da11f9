"""Operators of a training-data pipeline: filters, deduplication, extraction, chat repair and packing."""
