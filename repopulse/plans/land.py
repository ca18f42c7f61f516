"""Landing jobs: raw feed files to slim files per hour, and response logs to fetch records."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.payload import is_blank, is_json_object
from repopulse.operators.accounting import classify_requests
from repopulse.params import Params
from repopulse.plans import slimming
from repopulse.schemas import FETCH_OUTCOMES
from repopulse.session import prepare
from repopulse.sources import landing

log = logging.getLogger(__name__)


def slim_hours(
    spark: SparkSession,
    raw_root: str,
    landed_root: str,
    start: datetime,
    end: datetime,
    event_types: list[str] | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Slim the raw hours of `[start, end)` that have not landed, and report on every hour.

    Raw files carry their hour in the name. An hour that has landed is skipped and left alone, one
    without a raw file is missing. Each other hour is a job of its own, so one that can't be read is
    reported as failed, with the others untouched, and is tried again by the next run. Landed hours
    are entered in a manifest with their counts, also those of which the filter leaves no event.
    """
    grid = landing.hour_grid(prepare(spark), start, end)
    days = landing.days_of(start, end)
    landed = landing.landed_hours(spark, landed_root, days).withColumn("_landed", F.lit(True))
    raw = landing.keyed_files(spark, raw_root).groupBy("hour_key")
    raw = raw.agg(F.collect_list("path").alias("_paths"))
    marked = grid.join(landed, "hour_key", "left").join(raw, "hour_key", "left")
    # Hours and their files are bounded by the calendar.
    hours = marked.orderBy("hour").collect()

    def land(row) -> tuple:
        outcome, counts = "missing", (None, None, None)
        if row["_landed"]:
            outcome = "skipped"
        elif row["_paths"]:
            try:
                counts = _slim_hour(spark, row["_paths"], landed_root, row["hour_key"], event_types)
                outcome = "uploaded"
            except Exception as error:
                log.warning("%s failed: %s", row["hour_key"], error)
                outcome = "failed"
        return (row["hour"], row["hour_key"], outcome, *counts)

    with ThreadPoolExecutor(at_once) as pool:
        report = list(pool.map(land, hours))
    columns = "hour timestamp, hour_key string, outcome string, " + landing.HOUR_COUNTS
    done = spark.createDataFrame(report, columns)
    landing.enter_hours(done.where("outcome = 'uploaded'").drop("hour", "outcome"), landed_root)
    return done


def _slim_hour(
    spark: SparkSession,
    paths: list[str],
    landed_root: str,
    hour_key: str,
    event_types: list[str] | None,
) -> tuple[int, int, int]:
    """Land one hour; returns its good lines, the events kept and its bad lines."""
    lines = landing.read_lines(spark, paths, glob="*").select("value").where(~is_blank(F.col("value")))
    good = is_json_object(F.col("value"))
    seen, kept = Observation(), Observation()
    lines = lines.observe(seen, F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    slim = slimming.slim_events(lines, event_types).observe(kept, F.count("*").alias("rows"))
    dated = slim.withColumns(
        {"date": F.lit(hour_key.rpartition("-")[0]), "hour_key": F.lit(hour_key)}
    )
    landing.write_ndjson(dated, landed_root, ["date", "hour_key"], mode="overwrite")
    return seen.get["good"], kept.get["rows"], seen.get["bad"]


def land_fetches(
    responses: DataFrame,
    landed_root: str,
    day: date,
    force: bool = False,
    cap: int = Params().request_cap,
    reserve: int = Params().quota_reserve,
) -> bool:
    """Write the records of one fetch run, at most once per UTC day unless forced.

    Answers of any other status than the known ones are errors and leave no record, and neither does
    an answer that the log marks as rate-limited, whatever its status. With the columns of a run log
    (run_id, seq, remaining) only requests land that the run got to; see `classify_requests`.
    """
    spark = responses.sparkSession
    if not force and landing.landed_on(spark, landed_root, day):
        return False
    answered = _recorded(responses, cap, reserve)
    records = slimming.fetch_records(slimming.parse_bodies(answered))
    landing.write_ndjson(records.withColumn("date", F.lit(day.isoformat())), landed_root, ["date"])
    return True


def _recorded(responses: DataFrame, cap: int, reserve: int) -> DataFrame:
    """Responses that leave a record."""
    if {"run_id", "seq", "remaining", "rate_limited"} <= set(responses.columns):
        log = responses.withColumn("status", F.col("http_status"))
        classified = classify_requests(log, cap, reserve)
        recorded = classified.where(F.col("outcome").isin(*set(FETCH_OUTCOMES.values())))
        return recorded.select(responses.columns)
    answered = responses.where(F.col("http_status").isin(*FETCH_OUTCOMES))
    if "rate_limited" in responses.columns:
        answered = answered.where(~F.coalesce("rate_limited", F.lit(False)))
    return answered
