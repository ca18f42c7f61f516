"""Reusable DataFrame operators: ordering, ranking, history, upkeep and quality."""
