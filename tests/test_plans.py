"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from repopulse.checks import adapters, queries
from repopulse.operators.incremental import rows_to_recompute
from repopulse.operators.ranking import top_ranked
from repopulse.operators.scd2 import scd2
from repopulse.params import Params
from repopulse.plans import activity, trending
from repopulse.sources.tables import replace_partitions

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "daily")
    facts = activity.repo_daily_activity(adapters.activity(spark, SF_DIR))
    replace_partitions(facts, path, "event_date", ["repo_id"])
    return spark.read.parquet(path)


def test_daily_activity_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "events")
    adapters.activity(spark, SF_DIR).write.parquet(path)
    found = plan(activity.repo_daily_activity(spark.read.parquet(path)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", found).group(1)
    assert "event_id" not in schema and "actor_login" not in schema


def test_daily_activity_spreads_a_hot_repo_by_actor(spark):
    found = plan(activity.repo_daily_activity(adapters.activity(spark, SF_DIR)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", found)
    assert len(exchanges) == 2
    assert any("_bot" in keys or "actor" in keys or "CASE" in keys or keys.count("#") >= 3 for keys in exchanges)


def test_trending_prunes_partitions_by_the_latest_day(spark, daily):
    found = plan(trending.trending_ranks(daily, Params()))
    partition_filters = " ".join(re.findall(r"PartitionFilters: \[([^\]]*)\]", found))
    assert "event_date" in partition_filters and "subquery" in partition_filters.lower()
    assert "CartesianProduct" not in found and "BroadcastNestedLoopJoin" not in found


@pytest.mark.parametrize("n", [100, 5_000])
def test_top_k_keeps_k_rows_per_task_for_any_k(spark, daily, n):
    found = plan(top_ranked(daily, n, [daily.stars.desc(), daily.repo_id.asc()], "place"))
    assert "TakeOrderedAndProject" in found


def executed(df):
    """What is left of the plan when it has run."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_history_takes_one_shuffle_where_no_key_is_heavy(spark):
    """The branch of the slices is in every plan, and goes while it runs."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    log = orders.withColumn("at", orders.o_orderdate.cast("timestamp"))
    skewed = log.selectExpr("* except (o_custkey)", "if(o_custkey % 3 = 0, 0, o_custkey) AS o_custkey")
    found = {}
    for name, rows in (("even", log), ("skewed", skewed)):
        versions = scd2(rows, ["o_custkey"], "at", ["o_orderstatus"], ["o_orderkey"])
        assert "_slice" in plan(versions) and "NestedLoop" not in plan(versions)
        found[name] = executed(versions)
    assert len(re.findall(r"Exchange hashpartitioning", found["even"])) == 1
    assert "_slice" not in found["even"] and "Join" not in found["even"]
    assert "_slice" in found["skewed"]


def test_latest_fetch_takes_one_shuffle_and_no_join(spark):
    found = queries.latest_fetch(spark, SF_DIR)
    assert shuffles(found) == 1
    assert "Join" not in plan(found)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"contract_results"}))
def test_no_query_multiplies_rows_by_rows(spark, name):
    found = plan(queries.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in found
    assert "BroadcastNestedLoopJoin" not in found
    assert "BatchEvalPython" not in found and "ArrowEvalPython" not in found


def test_upkeep_prunes_the_dates_it_does_not_need(spark, tmp_path):
    path = str(tmp_path / "silver")
    adapters.activity(spark, SF_DIR).write.partitionBy("event_date").parquet(path)
    mark = 1_706_500_000_000_000
    found = plan(rows_to_recompute(spark.read.parquet(path), mark))
    filters = " ".join(re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", found)[0])
    assert "dynamicpruning" in filters
    assert "GreaterThan(_ingested_at" in found


def test_long_lists_are_not_broadcast(spark, daily):
    short, long = Params(trending_top_n=100), Params(trending_top_n=1_000_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for params, kind in ((short, "BroadcastHashJoin"), (long, "SortMergeJoin")):
            ranks = trending.trending_ranks(daily, params)
            dim = queries.repo_dim(spark, SF_DIR)
            described = plan(trending.trending_repos(ranks, dim, params))
            assert f"{kind} [repo_id" in described
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
