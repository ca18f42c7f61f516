"""Views, full rebuilds and tables replaced by partition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from repopulse import session
from repopulse.sources import tables


def days(spark, *numbers):
    data = [(dt.date(2026, 9, n), i) for n in numbers for i in range(5)]
    return spark.createDataFrame(data, "event_date date, repo_id bigint")


def test_replaced_partitions_leave_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.replace_partitions(days(spark, 1, 2), path, "event_date", ["repo_id"])
    changed = days(spark, 2, 3).withColumn("repo_id", F.col("repo_id") + 100)
    tables.replace_partitions(changed, path, "event_date", ["repo_id"])
    found = tables.scan(spark, "facts", str(tmp_path)).groupBy("event_date").agg(F.min("repo_id"))
    assert {(r[0].day, r[1]) for r in found.collect()} == {(1, 0), (2, 100), (3, 100)}
    # One file per date: small results of many tasks are merged before they are written.
    assert len(spark.read.parquet(path).inputFiles()) == 3


def test_rebuild_replaces_and_clusters(spark, tmp_path):
    path = str(tmp_path / "dim")
    tables.rebuild(days(spark, 1), path)
    tables.rebuild(spark.range(10_000).withColumnRenamed("id", "repo_id"), path, ["repo_id"])
    stored = spark.read.parquet(path)
    assert stored.count() == 10_000
    ranges = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min("repo_id").alias("low"), F.max("repo_id").alias("high")
    )
    ordered = [tuple(r) for r in ranges.orderBy("low").select("low", "high").collect()]
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_scans_by_folder_by_name_and_of_nothing(spark, tmp_path):
    assert tables.scan_if_exists(spark, "none", str(tmp_path)) is None
    tables.publish_view(days(spark, 1), "september")
    assert tables.scan(spark, "september").count() == 5


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
