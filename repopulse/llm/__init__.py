"""Operators of a training-data pipeline: filters, tokens, similarity joins, layout and packing."""
