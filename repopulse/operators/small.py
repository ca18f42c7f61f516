"""Joins that do not pile up: broadcasts of short lists only, and salting for frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def broadcast_up_to(df: DataFrame, bound: int) -> DataFrame:
    """Mark a DataFrame of at most `bound` rows for broadcast if that is few enough.

    `bound` must follow from the query itself, such as a top-k parameter. Beyond the limit the join
    is left to Spark, which shuffles, or broadcasts by measured size.
    """
    return F.broadcast(df) if bound <= MAX_BROADCAST_ROWS else df


def lookup(wanted: DataFrame, table: DataFrame, bound: int, key: str = "repo_id") -> DataFrame:
    """Rows of `table` for the keys of a list of at most `bound` rows.

    A short list is broadcast, so the table is filtered where it is read and never shuffled.
    """
    return table.join(broadcast_up_to(wanted.select(key).distinct(), bound), key, "left_semi")


def salted_left_join(
    rows: DataFrame, facts: DataFrame, key: str, salt_by: str, salts: int | None = None
) -> DataFrame:
    """Left join of many rows to one fact row per key, for keys that may hold very many rows.

    Each fact is repeated once per salt and the rows of a key are spread over the salts by another
    column, so a key is shared by that many tasks: as many as there are shuffle partitions. If Spark
    finds the facts small enough it broadcasts them all the same.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = facts.select("*", every_salt.alias("_salt"))
    return rows.withColumn("_salt", salt).join(salted, [key, "_salt"], "left").drop("_salt")
