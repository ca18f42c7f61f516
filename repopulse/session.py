"""Session settings the jobs rely on, and the shared folder for durable intermediate state."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the only runtime setting that changes results: dates and hours are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a session without that setting (a test on one machine) gets a temporary folder.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="repopulse-")
    spark.conf.set(SHARED_DIR_KEY, folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a DataFrame once and go on from files in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
