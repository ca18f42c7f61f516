"""Accounting of fetch runs: what became of each queued request, and whether the run is healthy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.operators.ranking import kth_smallest
from repopulse.operators.small import salted_left_join
from repopulse.schemas import FETCH_OUTCOMES


def classify_requests(log: DataFrame, cap: int, reserve: int) -> DataFrame:
    """Add `outcome` and `stopped_low_quota` to each row of a response log.

    The log holds (run_id, seq, status, remaining, rate_limited), one row per queued request in
    fetch order; `status` is null for a transport error. A run stops at the first rate-limited
    answer and after the first recorded answer that leaves at most `reserve` requests. Once `cap`
    requests have been paid for, the rest is deferred; an unchanged answer (304) is free.

    A run is described by two numbers, the seq of its cap-th paid request and its first stop, so
    no task has to walk through a run in order and a run of any size is spread over all tasks.
    """
    limited = F.coalesce("rate_limited", F.lit(False))
    known = F.coalesce(F.col("status").isin(*FETCH_OUTCOMES), F.lit(False))
    low_quota = ~limited & known & F.coalesce(F.col("remaining") <= reserve, F.lit(False))
    paid = ~limited & F.col("status").isNotNull() & (F.col("status") != 304)

    first_stop = F.min(F.when(limited | low_quota, F.col("seq")))
    stops = log.groupBy("run_id").agg(first_stop.alias("_stop"))
    if cap > 0:
        caps = kth_smallest(log.where(paid), ["run_id"], "seq", cap, "_cap")
        runs = stops.join(caps, "run_id", "left")
        deferred = F.coalesce(F.col("seq") > F.col("_cap"), F.lit(False))
        stop_counts = F.coalesce(F.col("_stop") <= F.col("_cap"), F.lit(True))
    else:
        runs, deferred, stop_counts = stops, F.lit(True), F.lit(False)

    effective = F.when(stop_counts, F.col("_stop"))
    named = F.create_map(*[F.lit(x) for pair in FETCH_OUTCOMES.items() for x in pair])
    outcome = (
        F.when(F.col("seq") > effective, "not_reached")
        .when(deferred, "deferred_cap")
        .when(limited, "stopped_rate_limited")
        .otherwise(F.coalesce(named[F.col("status")], F.lit("error")))
    )
    stopped = F.coalesce(low_quota & (F.col("seq") == effective), F.lit(False))
    return salted_left_join(log, runs, "run_id", "seq").select(
        *log.columns, outcome.alias("outcome"), stopped.alias("stopped_low_quota")
    )


def outcome_counters(classified: DataFrame) -> DataFrame:
    """Requests per run and outcome; a low-quota stop counts on top of the answer it followed."""
    names = F.when(
        F.col("stopped_low_quota"), F.array("outcome", F.lit("stopped_low_quota"))
    ).otherwise(F.array("outcome"))
    counted = classified.where(F.col("outcome") != "not_reached")
    return (
        counted.select("run_id", F.explode(names).alias("outcome"))
        .groupBy("run_id", "outcome")
        .agg(F.count("*").alias("requests"))
    )


def run_health(counters: DataFrame) -> DataFrame:
    """Attempts and errors per run; a run fails when more than half of its attempts are errors."""
    attempts = F.col("outcome").isin("ok", "not_modified", "not_found", "blocked", "error")
    n = F.col("requests")
    totals = counters.groupBy("run_id").agg(
        F.sum(F.when(attempts, n).otherwise(0)).alias("attempted"),
        F.sum(F.when(F.col("outcome") == "error", n).otherwise(0)).alias("errors"),
    )
    return totals.withColumn("failed", F.col("errors") * 2 > F.col("attempted"))
