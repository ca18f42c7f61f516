"""Maps the shared test tables to feed lines, events, fetch records and snapshots.

Everything downstream sees the same columns as in production. Users play repositories: user_id of
`events` and o_custkey of `orders` are one id space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.once import with_once
from repopulse.operators.scd2 import scd2
from repopulse.plans import silver
from repopulse.plans.slimming import fetch_records
from repopulse.schemas import TRACKED_ATTRIBUTES
from repopulse.session import prepare
from repopulse.sources.landing import event_rows

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# `events` as staged events, over (event_id, at, repo, k, kind).
ACTIVITY = {
    "event_id": "cast(event_id AS string)",
    "event_type": """CASE
        WHEN kind = 'view' AND k % 10 = 9 THEN 'ReleaseEvent'
        WHEN kind = 'view' THEN 'WatchEvent'
        WHEN kind = 'click' THEN 'PushEvent'
        WHEN kind = 'purchase' THEN 'ForkEvent'
        WHEN kind = 'signup' THEN 'PullRequestEvent'
        ELSE 'IssuesEvent' END""",
    "action": """CASE
        WHEN kind = 'view' AND k % 10 = 9 THEN 'published'
        WHEN kind = 'signup' THEN if(k % 2 = 0, 'opened', 'merged')
        WHEN kind = 'error' THEN 'opened' END""",
    "created_at": "at",
    "event_date": "to_date(at)",
    "event_hour": "hour(at)",
    "actor_id": "k",
    "actor_login": "if(k % 5 = 0, concat('u', k, '[bot]'), concat('u', k))",
    "is_bot": "k % 5 = 0",
    "repo_id": "repo",
    "repo_name": """if(repo % 7 = 0 AND at >= timestamp '2024-01-16 12:00:00',
        concat('o', repo % 10, '/r', repo, '-next'), concat('o', repo % 10, '/r', repo))""",
    "repo_owner": "concat('o', repo % 10)",
    "org_login": "if(repo % 3 = 0 AND k % 4 != 0, concat('org', repo % 10), NULL)",
    "_ingested_at": "cast(to_date(at) AS timestamp) + INTERVAL 27 HOURS",
}

# `events` as one raw feed line each, over the columns above and `spoil`.
FEED_LINE = f"""to_json(named_struct(
    'id', if(spoil = 7, NULL, event_id),
    'type', if(spoil = 4, 'SparkleEvent', event_type),
    'created_at', if(spoil = 0, 'yesterday', date_format(created_at, "{ISO}")),
    'public', true,
    'actor', named_struct('id', actor_id, 'login', actor_login),
    'repo', named_struct(
        'id', if(spoil = 2, NULL, repo_id),
        'name', if(spoil = 1, NULL, repo_name),
        'url', if(spoil = 8, 'https://feed.example/r', NULL)),
    'org', if(org_login IS NULL, NULL, named_struct('id', 9, 'login', org_login)),
    'payload', named_struct(
        'action', action,
        'number', actor_id,
        'is_draft', actor_id % 2 = 0,
        'detail', named_struct(
            'size', repo_id, 'labels', array('a', event_type), 'assignee', cast(NULL AS string))),
    'colour', if(spoil = 6, 'red', NULL)
), map('ignoreNullFields', 'false'))"""

SPOILED_LINE = """CASE spoil
    WHEN 2 THEN replace(line, '"repo":{"id":null', '"repo":{"id":"many"')
    WHEN 3 THEN left(line, 40)
    WHEN 5 THEN '[1]'
    WHEN 9 THEN concat(line, '] junk')
    WHEN 10 THEN concat(line, '} junk')
    WHEN 11 THEN concat(line, line)
    WHEN 12 THEN concat(line, '] ', line)
    ELSE line END"""

# `orders` as the service's answers, over (n, repo, price, priority, state, at, stamp).
ANSWER = {
    "id": "repo",
    "full_name": "concat('o', repo % 10, '/r', repo)",
    "owner": "named_struct('login', concat('o', repo % 10), 'type', 'User')",
    "description": "concat('order ', n)",
    "homepage": "if(n % 2 = 0, '', concat('https://r', repo, '.example'))",
    "language": "nullif(priority, '5-LOW')",
    "topics": "CASE n % 3 WHEN 0 THEN array('b', 'a') WHEN 1 THEN array('a', 'b') END",
    "license": "named_struct('spdx_id', state)",
    "fork": "false",
    "parent": "cast(NULL AS struct<full_name: string>)",
    "archived": "n % 50 = 7",
    "disabled": "false",
    "is_template": "false",
    "visibility": "'public'",
    "default_branch": "'main'",
    "size": "n % 1000",
    "stargazers_count": "floor(price / 100)",
    "forks_count": "floor(floor(price / 100) / 10)",
    "open_issues_count": "n % 40",
    "subscribers_count": "n % 7",
    "created_at": "concat(date_add(date '2023-11-15', cast(repo % 60 AS int)), 'T00:00:00Z')",
    "updated_at": "stamp",
    "pushed_at": "stamp",
}
ANSWER_STRUCT = ", ".join(f"'{name}', {value}" for name, value in ANSWER.items())
RESPONSE = {
    "repo_id": "repo",
    "requested_name": "concat('o', repo % 10, '/r', repo)",
    "fetched_at": "stamp",
    "http_status": "status",
    "response_etag": """if(n % 2 = 0, concat('"', n, '"'), NULL)""",
    "sent_etag": """concat('"', n, '"')""",
    "body": f"if(status = 200, named_struct({ANSWER_STRUCT}), NULL)",
}
STATUS = """CASE WHEN n % 20 = 0 THEN 404 WHEN n % 20 = 1 THEN 451
    WHEN n % 20 <= 6 THEN 304 ELSE 200 END"""

# `orders` as the response log of 50 fetch runs; one run gets a third of all requests.
RUN_LOG = {
    "run_id": "if(o_orderkey % 3 = 0, 0, o_custkey % 50)",
    "seq": "o_orderkey",
    "status": """CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 500
        WHEN o_orderkey % 20 = 0 THEN 404 WHEN o_orderkey % 20 = 1 THEN 451
        WHEN o_orderkey % 20 <= 6 THEN 304 ELSE 200 END""",
    "remaining": "5000 - o_orderkey % 5000",
    "rate_limited": "o_orderkey % 4999 = 4998",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, for work that is heavy per row on a table that may be one small file."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as staged events.

    Every seventh repository is renamed at noon of 2024-01-16, and the organisation is missing on
    some rows, so the latest name of a day is not just any name of it.
    """
    keyed = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(ts AS timestamp) AS at",
        "user_id AS repo",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
        "event_type AS kind",
    )
    return keyed.selectExpr(*_named(ACTIVITY))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as raw feed lines: nested payloads, unknown fields, and some spoiled lines.

    By event_id % 97: 0 unreadable time, 1 no repository name, 2 text as repository id, 3 broken
    JSON, 4 an unknown event type, 5 a JSON array, 6 an unknown field, 7 no id, 8 an unknown member, 9 to 12 something behind the
    object, which may close brackets that the line has not opened.
    """
    events = spread(activity(spark, sf_dir))
    rows = events.selectExpr("*", "cast(event_id AS bigint) % 97 AS spoil")
    written = with_once(rows, line=F.expr(FEED_LINE))
    spoiled = with_once(written, value=F.expr(SPOILED_LINE))
    return spoiled.selectExpr("value", "'feed.json.gz' AS _source_file", "event_id")


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(feed_lines(spark, sf_dir))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as the service's answers, one per order; `body` is a struct of API_REPO_DDL."""
    timed = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS n",
        "o_custkey AS repo",
        "o_totalprice AS price",
        "o_orderpriority AS priority",
        "o_orderstatus AS state",
        "timestamp '2024-01-01 00:00:00'"
        " + make_dt_interval(0, 0, cast(o_orderkey * 7919 % 43200 AS int)) AS at",
    )
    stamped = timed.selectExpr("*", f'date_format(at, "{ISO}") AS stamp', f"{STATUS} AS status")
    return stamped.selectExpr(*_named(RESPONSE))


def response_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers with the body as JSON text, null members included."""
    answers = spread(responses(spark, sf_dir)).withColumnRenamed("body", "answer")
    return with_once(answers, body=F.to_json("answer", {"ignoreNullFields": "false"}))


def landed_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers as landed fetch records, loaded three hours after the day they were made."""
    day = F.left("fetched_at", F.lit(10)).cast("timestamp")
    records = fetch_records(responses(spark, sf_dir)).withColumnRenamed("repo", "_repo")
    return with_once(records, repo=F.col("_repo")).select(
        "repo_id",
        "requested_name",
        "fetched_at",
        "http_status",
        "etag",
        "repo",
        (day + F.expr("INTERVAL 27 HOURS")).alias("_ingested_at"),
    )


def fetch_log(landed: DataFrame) -> DataFrame:
    return silver.staged_fetches(silver.type_fetches(landed))


def repo_history(landed: DataFrame) -> DataFrame:
    snapshots = silver.SNAPSHOT_RULES.keep(silver.repo_snapshots(landed))
    tracked = list(TRACKED_ATTRIBUTES)
    return silver.staged_history(
        scd2(snapshots, ["repo_id"], "fetched_at", tracked, tie=["description"])
    )


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log(landed_fetches(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repo_history(landed_fetches(spark, sf_dir))


def fetch_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_named(RUN_LOG))
