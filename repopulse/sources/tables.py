"""Stored tables: views, full rebuilds, and date-partitioned tables replaced by date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A source table, from a folder of parquet tables or from the session catalog."""
    return spark.read.parquet(f"{root}/{name}") if root else spark.table(name)


def scan_if_exists(spark: SparkSession, name: str, root: str) -> DataFrame | None:
    try:
        return scan(spark, name, root)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def rebuild(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> None:
    """Replace a whole table. `cluster_by` keeps equal values close, so scans skip row groups.

    Range partitioning samples the key, so a frequent value spreads over tasks if a second,
    finer column follows it.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition: str, sort_by: list[str], whole: bool = False
) -> None:
    """Replace only the partitions that occur in `df`; the others stay, or go too with `whole`.

    The rebalance hint lets adaptive execution merge small dates into one file and split a large
    date over several tasks.
    """
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
