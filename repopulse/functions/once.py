"""Keeping expensive expressions from being evaluated many times per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    The optimizer copies a projected expression into every later filter and projection that uses
    it, which for parsing JSON means parsing it many times. It does not copy through a generator,
    so the values pass through one that yields a single row.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
