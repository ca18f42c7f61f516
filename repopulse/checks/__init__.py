"""Queries over the shared test tables, and the same answers in another engine's SQL."""
