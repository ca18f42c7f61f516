"""Every query of the engine over the shared test tables, by name.

Each one runs over whole tables. Results hold strings, bigints, doubles and booleans only, so they
can be compared with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.checks import adapters as data
from repopulse.functions.payload import slim_payload
from repopulse.operators import accounting, incremental, scd2
from repopulse.params import Params
from repopulse.plans import (
    activity,
    contract,
    land,
    refresh_queue,
    reports,
    repos,
    silver,
    slimming,
    trending,
)
from repopulse.plans.gold import build_gold, side_by_side
from repopulse.session import shared_dir
from repopulse.sources import landing
from repopulse.sources.tables import rebuild, scan, scan_if_exists
from repopulse.streaming import batches, flows
from repopulse.streaming.history import repo_history_sink, track_history

# The test tables hold few repositories, so the caps are lower than in production.
PARAMS = Params(trending_top_n=25, active_top_n=40, refresh_top_n=30, request_cap=200)
AS_OF = "2024-01-31"
NOW = "2024-02-02 00:00:00"
QUEUED_AT = "2024-02-01 00:00:00"
LOAD_MARK = datetime(2024, 1, 20, 12, tzinfo=UTC)
KEPT_TYPES = ["WatchEvent", "ForkEvent"]


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _check_folder(spark: SparkSession) -> str:
    """A new folder for what a query stores."""
    return f"{shared_dir(spark)}/checks-{uuid4().hex}"


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, whole numbers as bigint, lists as joined text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


# --- landed data ----------------------------------------------------------------------------------


def slim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = slimming.slim_events(data.feed_lines(spark, sf_dir).select("value"), KEPT_TYPES)

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    return slim.select(
        text("id").alias("id"),
        "type",
        text("actor.login").alias("actor_login"),
        text("repo.id").alias("repo_id"),
        text("org.login").alias("org_login"),
        text("created_at").alias("created_at"),
        text("public").alias("public"),
        text("actor.id").alias("actor_id"),
        text("repo.name").alias("repo_name"),
        text("org.id").alias("org_id"),
        F.array_join(F.map_keys("payload"), ",").alias("payload_keys"),
        F.to_json("payload").alias("payload"),
    )


def slim_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = data.landed_events(spark, sf_dir)
    return landed.select("id", slim_payload(F.col("payload")).alias("payload"))


def slimming_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slimming.slimming_counts(data.feed_lines(spark, sf_dir), KEPT_TYPES)


def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.array_join(F.json_object_keys("_rescued_data"), ",")
    landed = data.landed_events(spark, sf_dir)
    return landed.groupBy(F.coalesce(fields, F.lit("")).alias("rescued_fields")).agg(
        F.count("*").alias("rows"), F.count("id").alias("rows_with_id")
    )


def fetch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = slimming.fetch_records(slimming.parse_bodies(data.response_texts(spark, sf_dir)))
    return records.select(
        "repo_id",
        "requested_name",
        "fetched_at",
        "http_status",
        "etag",
        "repo.*",
        F.col("repo").isNotNull().alias("has_repo"),
    )


def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feed lines as raw files of ten hours over two days, slimmed twice: what each run reports."""
    root = _check_folder(spark)
    start, end = datetime(2024, 1, 5, 18, tzinfo=UTC), datetime(2024, 1, 6, 6, tzinfo=UTC)
    hour = _moment("2024-01-05 18:00:00") + F.make_dt_interval(
        hours=(F.col("event_id").cast("bigint") % 10).cast("int")
    )
    lines = data.feed_lines(spark, sf_dir).select("value", landing.hour_key(hour).alias("hour"))
    lines.repartition("hour").write.partitionBy("hour").text(f"{root}/raw")
    runs = [
        land.slim_hours(spark, f"{root}/raw", f"{root}/landed", start, end, KEPT_TYPES)
        .drop("hour")
        .withColumn("run", F.lit(run))
        for run in (1, 2)
    ]
    return runs[0].unionByName(runs[1])


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service's answers landed as one day's records, once although asked twice, and read back."""
    root, day = _check_folder(spark), datetime(2024, 1, 31, tzinfo=UTC).date()
    answers = data.response_texts(spark, sf_dir)
    landed = [land.land_fetches(answers, root, day) for _ in range(2)]
    rows = landing.fetch_rows(landing.read_lines(spark, root))
    return rows.groupBy("http_status").agg(
        F.count("*").alias("records"),
        F.count("repo.id").alias("repositories"),
        F.sum("repo.stargazers_count").alias("stars"),
        F.lit(str(landed)).alias("landed"),
    )


def landing_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of January without any fork."""
    forks = data.activity(spark, sf_dir).where("event_type = 'ForkEvent'")
    landed = forks.select(landing.hour_key(F.col("created_at")).alias("hour_key"))
    start, end = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 31, tzinfo=UTC)
    return landing.missing_hours(landing.hour_grid(spark, start, end), landed)


# --- silver ---------------------------------------------------------------------------------------


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = silver.EVENT_RULES.keep(silver.type_events(data.landed_events(spark, sf_dir)))
    return typed.drop("_ingested_at")


def expectation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.EVENT_RULES.counts(silver.type_events(data.landed_events(spark, sf_dir)))


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.staged_events(data.activity(spark, sf_dir))


def repo_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.FETCH_RULES.keep(silver.type_fetches(data.landed_fetches(spark, sf_dir)))


def repo_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.SNAPSHOT_RULES.keep(silver.repo_snapshots(data.landed_fetches(spark, sf_dir)))


def repo_history_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.history(spark, sf_dir)


def history_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the stored history, as in a run."""
    root = _check_folder(spark)
    rebuild(data.history(spark, sf_dir), f"{root}/history")
    chain = scan(spark, "history", root)
    offences = scd2.broken_histories(chain, "repo_id", "valid_from", "valid_to")
    return offences.agg(F.count("*").alias("offences"))


def _order_log(spark: SparkSession, sf_dir: str, customer: str) -> DataFrame:
    return data.table(spark, sf_dir, "orders").selectExpr(
        f"{customer} AS customer",
        "cast(o_orderdate AS timestamp) AS ordered_at",
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
    )


def _order_history(log: DataFrame) -> DataFrame:
    tracked = ["o_orderstatus", "o_orderpriority"]
    versions = scd2.scd2(log, ["customer"], "ordered_at", tracked, ["o_orderkey"])
    return versions.withColumnsRenamed({scd2.START: "valid_from", scd2.END: "valid_to"})


def order_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history operator on another table: each customer's order status and priority."""
    return _order_history(_order_log(spark, sf_dir, "o_custkey"))


def skewed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same plan with a third of all orders under one customer, who is cut into time slices."""
    return _order_history(_order_log(spark, sf_dir, "if(o_custkey % 3 = 0, 0, o_custkey)"))


# --- streams --------------------------------------------------------------------------------------


def _land(spark: SparkSession, lines: DataFrame, root: str, within: str | None = None) -> None:
    """More feed lines as files, loaded through bronze into silver; each call starts the flows anew."""
    landed = lines.select("value").write.mode("append").option("compression", "gzip")
    landed.text(f"{root}/landed")
    flows.load_events(spark, f"{root}/landed", f"{root}/bronze", f"{root}/_b", glob="part-*")
    flows.type_events(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/_s", f"{root}/records", within
    )


def _part(lines: DataFrame, number: int, parts: int = 2) -> DataFrame:
    return lines.where(F.col("event_id").cast("bigint") % parts == number)


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed lines landed as files in two parts, each loaded through bronze into silver."""
    root, lines = _check_folder(spark), data.feed_lines(spark, sf_dir)
    for number in (0, 1):
        _land(spark, _part(lines, number), root)
    return scan(spark, "silver", root).drop("_ingested_at", "_source_file", "load")


def streamed_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of two runs have recorded, read back from storage."""
    root, lines = _check_folder(spark), data.feed_lines(spark, sf_dir)
    for number in (0, 1):
        _land(spark, _part(lines, number), root)
    return batches.violations(spark, f"{root}/records", "silver_events")


def streamed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines landed, and every third of them a second time after a restart; copies go."""
    root, lines = _check_folder(spark), data.feed_lines(spark, sf_dir)
    _land(spark, lines, root, within="90 days")
    _land(spark, _part(lines, 0, 3), root, within="90 days")
    return scan(spark, "silver", root).drop("_ingested_at", "_source_file", "load")


def ledger_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts kept up to date from a ledger of loads: two landings, an upkeep run after each.

    The second landing holds the later half of the dates and late lines of some early ones.
    """
    root = _check_folder(spark)
    # Written once, as both landings are cut from them.
    rebuild(data.feed_lines(spark, sf_dir), f"{root}/lines")
    lines = scan(spark, "lines", root)
    late = lines.where("value LIKE '%2024-01-2%' OR cast(event_id AS bigint) % 9 = 0")
    for some in (lines.join(late.select("event_id"), "event_id", "left_anti"), late):
        _land(spark, some, root)
        table = incremental.refresh(
            spark,
            silver.staged_events(scan(spark, "silver", root)),
            activity.repo_daily_activity,
            "daily",
            root,
            ["repo_id"],
            ledger=batches.ledger(spark, f"{root}/records", "silver_events"),
        )
    return table.drop("_loaded_through")


def streamed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch records landed in three parts, mixed in time, and followed into the history table."""
    root = _check_folder(spark)
    records = data.spread(data.landed_fetches(spark, sf_dir)).drop("_ingested_at")
    sink = repo_history_sink(spark, f"{root}/silver_history", fan=2)
    for part in range(3):
        landed = records.where(F.pmod(F.xxhash64("etag"), F.lit(3)) == part)
        landed.write.mode("append").option("compression", "gzip").json(f"{root}/landed")
        flows.load_fetches(
            spark, f"{root}/landed", f"{root}/bronze", f"{root}/_b", glob="part-*"
        )
        track_history(spark, f"{root}/bronze", sink, f"{root}/_h", f"{root}/records")
    return silver.staged_history(sink.history())


# --- gold -----------------------------------------------------------------------------------------


def repo_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.repo_daily_activity(data.activity(spark, sf_dir))


def hourly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.hourly_activity(data.activity(spark, sf_dir))


def _late_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth event of the early days is loaded late, so old dates change as well."""
    late = (F.col("event_id").cast("bigint") % 9 == 0) & (F.col("event_date") < "2024-01-10")
    loaded = F.when(late, _moment(QUEUED_AT)).otherwise(F.col("_ingested_at"))
    return data.activity(spark, sf_dir).withColumn("_ingested_at", loaded)


def changed_dates_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load up to a mark, then upkeep with everything that came later or late."""
    events = _late_activity(spark, sf_dir)
    mark = int(LOAD_MARK.timestamp()) * 1_000_000
    first_load = events.where(F.col("_ingested_at") <= F.timestamp_micros(F.lit(mark)))
    table = activity.repo_daily_activity(first_load)
    fresh = activity.repo_daily_activity(incremental.rows_to_recompute(events, mark))
    return incremental.merge_dates(table, fresh)


def daily_activity_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table: a full build, then an upkeep run with the later loads."""
    root = _check_folder(spark)
    events = _late_activity(spark, sf_dir)
    mark = int(LOAD_MARK.timestamp()) * 1_000_000
    first_load = events.where(F.col("_ingested_at") <= F.timestamp_micros(F.lit(mark)))
    for source in (first_load, events):
        table = incremental.refresh(
            spark, source, activity.repo_daily_activity, "daily", root, ["repo_id"]
        )
    columns = activity.repo_daily_activity(events).columns
    return table.select(*columns)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table through full refreshes, built beside it and published: from all events, from a
    source that has lost its later dates, and from one that has lost them all."""
    root, beside = _check_folder(spark), _check_folder(spark)
    events = data.activity(spark, sf_dir)
    found = []
    for step, kept in (("all", "true"), ("shrunk", "event_date < '2024-01-15'"), ("empty", "false")):
        incremental.refresh(
            spark, events.where(kept), activity.repo_daily_activity, "daily", root, ["repo_id"],
            full=True, beside=beside,
        )
        incremental.publish(spark, "daily", root, beside, ["repo_id"], full=True)
        stored = scan_if_exists(spark, "daily", root)
        rows = 0 if stored is None else stored.count()
        total = None if stored is None else stored.agg(F.sum("total_events")).first()[0]
        found.append((step, rows, total or 0))
    return spark.createDataFrame(found, "step string, rows bigint, events bigint")


def latest_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repos.latest_fetch(data.fetches(spark, sf_dir))


def _repo_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The dimension and the fetch state it is built on."""
    landed = data.landed_fetches(spark, sf_dir)
    state = repos.latest_fetch(data.fetch_log(landed))
    return repos.repo_dim(data.repo_history(landed), state, _day(AS_OF)), state


def repo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repo_tables(spark, sf_dir)[0]


def repo_snapshot_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repos.repo_snapshot_daily(data.fetches(spark, sf_dir))


def trending_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = trending.trending_ranks(repo_daily_activity(spark, sf_dir), PARAMS)
    return trending.trending_repos(ranks, repo_dim(spark, sf_dir), PARAMS)


def trending_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, dim = repo_daily_activity(spark, sf_dir), repo_dim(spark, sf_dir)
    ranks = trending.trending_ranks(daily, PARAMS)
    return trending.trending_languages(daily, dim, ranks, PARAMS)


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = repo_daily_activity(spark, sf_dir)
    ranks = trending.trending_ranks(daily, PARAMS)
    dim, state = _repo_tables(spark, sf_dir)
    return refresh_queue.refresh_queue(daily, ranks, dim, state, PARAMS, _moment(QUEUED_AT))


def queue_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh_queue.next_requests(queue(spark, sf_dir), 20)


# --- fetch runs -----------------------------------------------------------------------------------


def fetch_run_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = data.fetch_run_log(spark, sf_dir)
    done = accounting.classify_requests(log, PARAMS.request_cap, PARAMS.quota_reserve)
    return done.select("run_id", "seq", "outcome", "stopped_low_quota")


def outcome_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.outcome_counters(fetch_run_accounting(spark, sf_dir))


def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.run_health(outcome_counters(spark, sf_dir))


# --- reports --------------------------------------------------------------------------------------


def _over_daily(report: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: report(repo_daily_activity(spark, sf_dir))


def _over_hourly(report: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: report(hourly_activity(spark, sf_dir))


def _over_trending(report: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: report(trending_repos(spark, sf_dir))


def pull_requests_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pull_requests_by_day(
        repo_daily_activity(spark, sf_dir), hourly_activity(spark, sf_dir)
    )


def repeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the even ids landed twice."""
    events = data.activity(spark, sf_dir)
    again = events.where(F.col("event_id").cast("bigint") % 2 == 0)
    return reports.repeated_events(events.unionByName(again))


def repository_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repository_profile(repo_dim(spark, sf_dir))


def enrichment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = trending.trending_ranks(repo_daily_activity(spark, sf_dir), PARAMS)
    return reports.enrichment_coverage(ranks, repo_dim(spark, sf_dir), PARAMS)


def history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.history_changes(data.history(spark, sf_dir))


# --- quality --------------------------------------------------------------------------------------


def contract_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole contract, over tables that are built and stored once, as a run does."""
    return contract.contract_results(stored_tables(spark, sf_dir), _moment(NOW))


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = _check_folder(spark)
    staged = {
        "events": data.activity(spark, sf_dir),
        "repo_fetches": data.fetches(spark, sf_dir),
        "repo_history": data.history(spark, sf_dir),
    }

    def store(name: str) -> DataFrame:
        rebuild(staged[name], f"{root}/{name}")
        return scan(spark, name, root)

    stored: dict[str, DataFrame] = {}
    side_by_side(stored, **{name: partial(store, name) for name in staged})
    return build_gold(spark, stored, root, PARAMS, as_of=_day(AS_OF), queued_at=_moment(QUEUED_AT))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.source_freshness(
        data.activity(spark, sf_dir), data.fetches(spark, sf_dir), _moment(NOW)
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "slim_events": slim_events,
    "slim_payload": slim_payload_text,
    "slimming_counts": slimming_counts,
    "rescued_data": rescued_data,
    "fetch_records": fetch_records,
    "landing_gaps": landing_gaps,
    "landing_report": landing_report,
    "landed_records": landed_records,
    "silver_events": silver_events,
    "expectation_counts": expectation_counts,
    "staged_events": staged_events,
    "repo_fetches": repo_fetches,
    "repo_snapshots": repo_snapshots,
    "repo_history_scd2": repo_history_scd2,
    "history_contiguity": history_contiguity,
    "order_status_history": order_status_history,
    "skewed_history": skewed_history,
    "streamed_events": streamed_events,
    "streamed_history": streamed_history,
    "streamed_violations": streamed_violations,
    "streamed_dedup": streamed_dedup,
    "ledger_upkeep": ledger_upkeep,
    "repo_daily_activity": repo_daily_activity,
    "hourly_activity": hourly_activity,
    "changed_dates_recompute": changed_dates_recompute,
    "daily_activity_upkeep": daily_activity_upkeep,
    "full_refresh": full_refresh,
    "latest_fetch": latest_fetch,
    "repo_dim": repo_dim,
    "repo_snapshot_daily": repo_snapshot_daily,
    "trending_repos": trending_repos,
    "trending_languages": trending_languages,
    "refresh_queue": queue,
    "queue_head": queue_head,
    "fetch_run_accounting": fetch_run_accounting,
    "outcome_counters": outcome_counters,
    "run_health": run_health,
    "headline_figures": _over_daily(reports.headline_figures),
    "trending_panel": _over_trending(reports.trending_panel),
    "breakout_repos": _over_trending(reports.breakout_repos),
    "activity_by_hour": _over_hourly(reports.activity_by_hour),
    "activity_by_day": _over_hourly(reports.activity_by_day),
    "pull_requests_by_day": pull_requests_by_day,
    "merge_automation": _over_daily(reports.merge_automation),
    "event_mix": _over_hourly(reports.event_mix),
    "bot_share": _over_hourly(reports.bot_share),
    "events_per_hour": _over_hourly(reports.events_per_hour),
    "repeated_events": repeated_events,
    "repository_profile": repository_profile,
    "enrichment_coverage": enrichment_coverage,
    "history_changes": history_changes,
    "contract_results": contract_results,
    "freshness": freshness,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(query):
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: run(query) for name, query in QUERIES.items()}
