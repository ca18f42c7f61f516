"""The same answers in plain SQL for another engine, over the same test tables.

Written from the definitions, not from the Spark plans: row numbers where Spark uses struct maxima,
joins where Spark uses one aggregate.
"""

from __future__ import annotations

T = "'%Y-%m-%d %H:%M:%S.%f'"

ACTIVITY = f"""
keyed AS (
  SELECT event_id, ts, user_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
activity AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    event_id AS event_no,
    CASE
      WHEN kind = 'view' AND k % 10 = 9 THEN 'ReleaseEvent'
      WHEN kind = 'view' THEN 'WatchEvent'
      WHEN kind = 'click' THEN 'PushEvent'
      WHEN kind = 'purchase' THEN 'ForkEvent'
      WHEN kind = 'signup' THEN 'PullRequestEvent'
      ELSE 'IssuesEvent'
    END AS event_type,
    CASE
      WHEN kind = 'view' AND k % 10 = 9 THEN 'published'
      WHEN kind = 'signup' AND k % 2 = 0 THEN 'opened'
      WHEN kind = 'signup' THEN 'merged'
      WHEN kind = 'error' THEN 'opened'
    END AS action,
    ts AS created_at,
    CAST(ts AS DATE) AS event_date,
    CAST(hour(ts) AS BIGINT) AS event_hour,
    k AS actor_id,
    'u' || k || CASE WHEN k % 5 = 0 THEN '[bot]' ELSE '' END AS actor_login,
    k % 5 = 0 AS is_bot,
    user_id AS repo_id,
    'o' || (user_id % 10) || '/r' || user_id
      || CASE WHEN user_id % 7 = 0 AND ts >= TIMESTAMP '2024-01-16 12:00:00' THEN '-next' ELSE '' END AS repo_name,
    'o' || (user_id % 10) AS repo_owner,
    CASE WHEN user_id % 3 = 0 AND k % 4 <> 0 THEN 'org' || (user_id % 10) END AS org_login,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 27 HOUR AS _ingested_at
  FROM keyed
)"""

LATE_ACTIVITY = """
late_activity AS (
  SELECT * REPLACE (
    CASE WHEN event_no % 9 = 0 AND event_date < DATE '2024-01-10'
      THEN TIMESTAMP '2024-02-01 00:00:00' ELSE _ingested_at END AS _ingested_at)
  FROM activity
)"""


def daily_of(source: str, name: str = "daily") -> str:
    return f"""
{name}_names AS (
  SELECT event_date, repo_id, repo_name, org_login FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_date, repo_id
      ORDER BY created_at DESC, repo_name DESC NULLS LAST, org_login DESC NULLS LAST) AS n
    FROM {source})
  WHERE n = 1
),
{name} AS (
  SELECT
    a.event_date, a.repo_id, any_value(l.repo_name) AS repo_name, any_value(l.org_login) AS org_login,
    count(*) FILTER (event_type = 'WatchEvent') AS stars,
    count(*) FILTER (event_type = 'ForkEvent') AS forks,
    count(*) FILTER (event_type = 'PushEvent') AS pushes,
    count(*) FILTER (event_type = 'PullRequestEvent' AND action = 'opened') AS pull_requests_opened,
    count(*) FILTER (event_type = 'PullRequestEvent' AND action = 'merged') AS pull_requests_merged,
    count(*) FILTER (event_type = 'IssuesEvent' AND action = 'opened') AS issues_opened,
    count(*) FILTER (event_type = 'ReleaseEvent' AND action = 'published') AS releases,
    count(DISTINCT actor_id) FILTER (NOT is_bot) AS unique_human_actors,
    count(*) AS total_events,
    count(*) FILTER (is_bot) AS bot_events,
    max(_ingested_at) AS _loaded_through
  FROM {source} a JOIN {name}_names l ON a.event_date = l.event_date AND a.repo_id = l.repo_id
  GROUP BY a.event_date, a.repo_id
)"""


DAILY = daily_of("activity")

LOADED_THROUGH = f", strftime(_loaded_through, {T}) AS _loaded_through"

DAILY_COLUMNS = f"""
  CAST(event_date AS VARCHAR) AS event_date, repo_id, repo_name, org_login, stars, forks, pushes,
  pull_requests_opened, pull_requests_merged, issues_opened, releases, unique_human_actors,
  total_events, bot_events{LOADED_THROUGH}"""

HOURLY = """
hourly AS (
  SELECT event_date, event_hour, event_type, count(*) AS events,
    count(*) FILTER (is_bot) AS bot_events, count(DISTINCT actor_id) AS unique_actors,
    max(_ingested_at) AS _loaded_through
  FROM activity GROUP BY ALL
),
full_days AS (
  SELECT event_date FROM hourly GROUP BY event_date HAVING count(DISTINCT event_hour) = 24
)"""

FETCHES = """
fetches AS (
  SELECT
    o_custkey AS repo_id,
    o_custkey AS queued_repo_id,
    'o' || (o_custkey % 10) || '/r' || o_custkey AS requested_name,
    CASE WHEN status = 200 THEN 'o' || (o_custkey % 10) || '/r' || o_custkey END AS full_name,
    fetched_at,
    status AS http_status,
    CASE WHEN status = 200 THEN 'ok' WHEN status = 304 THEN 'not_modified'
      WHEN status = 404 THEN 'not_found' ELSE 'blocked' END AS fetch_outcome,
    '"' || o_orderkey || '"' AS etag,
    CASE WHEN status = 200 THEN CAST(floor(o_totalprice / 100) AS BIGINT) END AS stargazers_count,
    CASE WHEN status = 200 THEN CAST(floor(floor(o_totalprice / 100) / 10) AS BIGINT) END AS forks_count,
    CASE WHEN status = 200 THEN o_orderkey % 40 END AS open_issues_count,
    CASE WHEN status = 200 THEN o_orderkey % 7 END AS subscribers_count,
    CASE WHEN status = 200 THEN o_orderkey % 1000 END AS size_kb,
    CASE WHEN status = 200 THEN fetched_at END AS pushed_at,
    CAST(CAST(fetched_at AS DATE) AS TIMESTAMP) + INTERVAL 27 HOUR AS _ingested_at,
    o_orderkey,
    'o' || (o_custkey % 10) AS owner_login,
    'order ' || o_orderkey AS description,
    CASE WHEN o_orderkey % 2 = 1 THEN 'https://r' || o_custkey || '.example' END AS homepage,
    nullif(o_orderpriority, '5-LOW') AS language,
    CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE 'a,b' END AS topics,
    o_orderstatus AS license_spdx_id,
    o_orderkey % 50 = 7 AS is_archived,
    CAST(DATE '2023-11-15' + CAST(o_custkey % 60 AS INTEGER) AS TIMESTAMP) AS repo_created_at
  FROM (
    SELECT *,
      TIMESTAMP '2024-01-01 00:00:00' + to_minutes(o_orderkey * 7919 % 43200) AS fetched_at,
      CASE WHEN o_orderkey % 20 = 0 THEN 404 WHEN o_orderkey % 20 = 1 THEN 451
        WHEN o_orderkey % 20 <= 6 THEN 304 ELSE 200 END AS status
    FROM orders)
)"""

HISTORY = """
snapshots AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_id, fetched_at ORDER BY description DESC) AS n
    FROM fetches WHERE http_status = 200)
  WHERE n = 1
),
compared AS (
  SELECT *, lag(fetched_at) OVER w IS NULL
    OR lag(full_name) OVER w IS DISTINCT FROM full_name
    OR lag(owner_login) OVER w IS DISTINCT FROM owner_login
    OR lag(language) OVER w IS DISTINCT FROM language
    OR lag(topics) OVER w IS DISTINCT FROM topics
    OR lag(license_spdx_id) OVER w IS DISTINCT FROM license_spdx_id
    OR lag(is_archived) OVER w IS DISTINCT FROM is_archived AS is_new
  FROM snapshots WINDOW w AS (PARTITION BY repo_id ORDER BY fetched_at)
),
numbered AS (
  SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (PARTITION BY repo_id ORDER BY fetched_at) AS version
  FROM compared
),
spans AS (
  SELECT repo_id, version, min(fetched_at) AS valid_from, max(fetched_at) AS last_seen
  FROM numbered GROUP BY repo_id, version
),
history AS (
  SELECT n.* EXCLUDE (version, fetched_at, is_new), s.valid_from,
    lead(s.valid_from) OVER (PARTITION BY n.repo_id ORDER BY s.valid_from) AS valid_to
  FROM numbered n JOIN spans s
    ON n.repo_id = s.repo_id AND n.version = s.version AND n.fetched_at = s.last_seen
)"""

SNAPSHOT_COLUMNS = f"""
  repo_id, full_name, owner_login, 'User' AS owner_type, description, homepage, language, topics,
  license_spdx_id, false AS is_fork, CAST(NULL AS VARCHAR) AS parent_full_name, is_archived,
  false AS is_disabled, false AS is_template, 'public' AS visibility, 'main' AS default_branch,
  strftime(repo_created_at, {T}) AS repo_created_at"""

STATE = """
state AS (
  SELECT * EXCLUDE (shown), latest_outcome IN ('ok', 'not_modified') AS is_available, shown.*
  FROM (
    SELECT repo_id, max(fetched_at) AS last_checked_at,
      arg_max(fetch_outcome, {'t': fetched_at, 'e': etag}) AS latest_outcome,
      arg_max(etag, {'t': fetched_at, 'e': etag})
        FILTER (fetch_outcome = 'ok' OR fetch_outcome = 'not_modified') AS last_etag,
      max(fetched_at) FILTER (fetch_outcome = 'ok') AS metrics_as_of,
      arg_max({'stargazers_count': stargazers_count, 'forks_count': forks_count,
          'open_issues_count': open_issues_count, 'subscribers_count': subscribers_count,
          'pushed_at': pushed_at}, {'t': fetched_at, 'e': etag}) FILTER (fetch_outcome = 'ok') AS shown
    FROM fetches GROUP BY repo_id)
)"""

# A repository's versions as one row: how many, since when, and the one that began last.
DIM = """
lives AS (
  SELECT repo_id, count(*) AS version_count, min(valid_from) AS first_seen_at,
    arg_max(history, valid_from) AS latest
  FROM history GROUP BY repo_id HAVING bool_or(valid_to IS NULL)
),
dim AS (
  SELECT unnest(latest), version_count, first_seen_at, state.is_available, state.latest_outcome,
    state.last_checked_at, state.stargazers_count AS total_stars, state.forks_count AS total_forks,
    state.open_issues_count AS issues_now, state.subscribers_count AS subscribers_now,
    state.pushed_at AS pushed_now, state.metrics_as_of
  FROM lives LEFT JOIN state USING (repo_id)
)"""

# Days by their age at the last day of the facts: 0 to 6 are the window, 7 to 13 the one before.
TOP = """
as_of AS (FROM daily SELECT event_date AS d ORDER BY event_date DESC LIMIT 1),
aged AS (SELECT daily.*, date_diff('day', event_date, d) AS age FROM daily JOIN as_of ON event_date <= d),
top AS (
  SELECT *, row_number() OVER (ORDER BY now_stars DESC, now_forks DESC, repo_name, repo_id) AS place
  FROM (
    SELECT repo_id, last(repo_name ORDER BY age DESC) AS repo_name,
      coalesce(sum(stars) FILTER (age < 7), 0) AS now_stars,
      coalesce(sum(stars) FILTER (age >= 7), 0) AS prior_stars,
      coalesce(sum(forks) FILTER (age < 7), 0) AS now_forks
    FROM aged WHERE age < 14 GROUP BY repo_id)
  WHERE now_stars > 0
  QUALIFY place <= 25
)"""

TRENDING = f"""
trending AS (
  SELECT place AS trending_rank, top.repo_id, top.repo_name, CAST(d AS VARCHAR) AS as_of_date,
    now_stars::BIGINT AS stars_in_window, prior_stars::BIGINT AS stars_prior_window,
    (now_stars - prior_stars)::BIGINT AS star_delta,
    CASE WHEN prior_stars > 0 THEN round(100 * (now_stars::DOUBLE - prior_stars) / prior_stars, 1) END
      AS star_growth_pct,
    now_forks::BIGINT AS forks_in_window, dim.language, dim.description,
    strftime(dim.repo_created_at, {T}) AS repo_created_at, dim.total_stars,
    date_diff('microsecond', dim.repo_created_at, d::TIMESTAMP) <= 30 * 86400000000 AS is_new_repo
  FROM top LEFT JOIN dim USING (repo_id) JOIN as_of ON true
)"""

# A language is the list of its starred repositories, best first; all figures come from the list.
LANGUAGES = """
shelves AS (
  SELECT coalesce(dim.language, 'No language') AS language,
    list({'n': n, 'id': dim.repo_id, 'name': dim.full_name} ORDER BY n DESC, dim.repo_id) AS repos
  FROM dim JOIN (SELECT repo_id, sum(stars) AS n FROM aged WHERE age < 7 GROUP BY ALL) USING (repo_id)
  WHERE n > 0 GROUP BY ALL
),
weighed AS (
  SELECT language, repos, list_sum(list_transform(repos, lambda r: r.n)) AS total,
    (SELECT list(repo_id) FROM top) AS best
  FROM shelves
),
ranked_languages AS (
  SELECT (SELECT count(*) FROM weighed w WHERE w.total > weighed.total
      OR w.total = weighed.total AND w.language <= weighed.language) AS language_rank,
    language, len(repos) AS repos_with_stars, CAST(total AS BIGINT) AS stars_in_window,
    round(100 * CAST(total AS DOUBLE) / (SELECT sum(total) FROM weighed), 1) AS stars_share_pct,
    len(list_filter(repos, lambda r: list_contains(best, r.id))) AS trending_repos,
    repos[1].name AS top_repo, CAST(repos[1].n AS BIGINT) AS top_repo_stars,
    (SELECT CAST(d AS VARCHAR) FROM as_of) AS as_of_date
  FROM weighed
)"""

# Each source gives (source, place); a repository's best pair decides its reason and its turn.
QUEUE = """
wishes AS (
  SELECT repo_id, repo_name AS shown, 1 AS source, place FROM top
  UNION ALL
  (SELECT repo_id, repo_name, 2, row_number() OVER (
      ORDER BY unique_human_actors DESC, total_events DESC, repo_id) AS place
    FROM aged WHERE age = 0 AND unique_human_actors > 0 QUALIFY place <= 40)
  UNION ALL
  (SELECT repo_id, dim.full_name, 3, row_number() OVER (ORDER BY state.last_checked_at, repo_id) AS place
    FROM state JOIN dim USING (repo_id)
    WHERE state.is_available
      AND date_diff('microsecond', state.last_checked_at, (SELECT d FROM as_of)::TIMESTAMP) > 7 * 86400000000
    QUALIFY place <= 30)
),
turns AS (
  SELECT repo_id, min([source, place]) AS turn, arg_min(shown, [source, place]) AS shown
  FROM wishes GROUP BY repo_id
),
barred AS (
  SELECT repo_id FROM state WHERE latest_outcome IN ('blocked', 'not_found')
    AND date_diff('microsecond', last_checked_at, (SELECT d FROM as_of)::TIMESTAMP) <= 30 * 86400000000
),
queue AS (
  SELECT row_number() OVER (ORDER BY turn, repo_id) AS priority, repo_id,
    coalesce((SELECT full_name FROM dim WHERE dim.repo_id = turns.repo_id), shown) AS repo_name,
    ['trending', 'most_active', 'refresh'][turn[1]] AS reason, state.last_etag AS etag,
    state.last_checked_at
  FROM turns LEFT JOIN state USING (repo_id) ANTI JOIN barred USING (repo_id)
)"""

FEED = """
feed AS (
  SELECT *, event_no % 97 AS spoil,
    '{"action":' || coalesce('"' || action || '"', 'null') || ',"number":' || actor_id || ',"is_draft":'
      || (actor_id % 2 = 0) || ',"detail":{"size":' || repo_id || ',"labels":["a","' || event_type
      || '"],"assignee":null}}' AS payload
  FROM activity
)"""

RUNS = """
log AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 50 END AS run_id, o_orderkey AS seq,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 500
      WHEN o_orderkey % 20 = 0 THEN 404 WHEN o_orderkey % 20 = 1 THEN 451
      WHEN o_orderkey % 20 <= 6 THEN 304 ELSE 200 END AS status,
    5000 - o_orderkey % 5000 AS remaining, o_orderkey % 4999 = 4998 AS limited
  FROM orders
),
priced AS (
  SELECT *, coalesce(status IN (200, 304, 403, 404, 451), false) AS known,
    coalesce(sum(CASE WHEN limited OR status IS NULL OR status = 304 THEN 0 ELSE 1 END) OVER (
      PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
  FROM log
),
flagged AS (
  SELECT *, spent < 200 AND (limited OR (known AND remaining <= 25)) AS is_stop FROM priced
),
walked AS (
  SELECT *, coalesce(max(CASE WHEN is_stop THEN 1 ELSE 0 END) OVER (
    PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS stopped
  FROM flagged
),
requests AS (
  SELECT run_id, seq,
    CASE WHEN stopped THEN 'not_reached' WHEN spent >= 200 THEN 'deferred_cap'
      WHEN limited THEN 'stopped_rate_limited' WHEN status = 200 THEN 'ok'
      WHEN status = 304 THEN 'not_modified' WHEN status = 404 THEN 'not_found'
      WHEN status IN (403, 451) THEN 'blocked' ELSE 'error' END AS outcome,
    NOT stopped AND is_stop AND NOT limited AS stopped_low_quota
  FROM walked
),
counters AS (
  SELECT run_id, outcome, count(*) AS requests FROM (
    SELECT run_id, outcome FROM requests WHERE outcome <> 'not_reached'
    UNION ALL SELECT run_id, 'stopped_low_quota' FROM requests WHERE stopped_low_quota)
  GROUP BY ALL
)"""

# A version must end when the next one of its repository begins, looked up one by one.
CHAIN = """
offences AS (
  SELECT h.repo_id FROM history h ASOF JOIN history later
    ON h.repo_id = later.repo_id AND h.valid_from < later.valid_from
  WHERE h.valid_to IS DISTINCT FROM later.valid_from
  UNION ALL
  SELECT repo_id FROM (SELECT DISTINCT repo_id FROM history) r
  WHERE (SELECT count(*) FROM history h WHERE h.repo_id = r.repo_id AND h.valid_to IS NULL) <> 1
)"""



def query(select: str, *parts: str) -> str:
    """A statement over the named parts, in order, each once."""
    return f"WITH {','.join(dict.fromkeys(parts))}\n{select}"


REPO_PARTS = (FETCHES, HISTORY, STATE, DIM)
TOP_PARTS = (ACTIVITY, DAILY, *REPO_PARTS, TOP)


def not_null(table: str, source: str, column: str) -> str:
    return f"SELECT '{table}.not_null_{column}', 'error', count(*) FROM {source} WHERE {column} IS NULL"


def unique(table: str, source: str, columns: str, severity: str = "error", where: str = "true") -> str:
    name = columns.replace(", ", "_")
    return (
        f"SELECT '{table}.unique_{name}', '{severity}', count(*) FROM ("
        f"SELECT {columns} FROM {source} WHERE {where} GROUP BY {columns} HAVING count(*) > 1)"
    )


def outcomes(table: str, source: str, column: str) -> str:
    return (
        f"SELECT '{table}.accepted_{column}', 'error', count(DISTINCT {column}) FROM {source} "
        f"WHERE {column} NOT IN ('ok', 'not_modified', 'not_found', 'blocked', 'other')"
    )


CONTRACT = "\nUNION ALL ".join(
    [
        "SELECT 'events.not_null_event_id' AS test, 'error' AS severity, count(*) AS failures FROM activity WHERE event_id IS NULL",
        unique("events", "activity", "event_id", "warn", "_ingested_at >= TIMESTAMP '2024-01-31 00:00:00'"),
        not_null("events", "activity", "event_type"),
        not_null("events", "activity", "event_date"),
        "SELECT 'events.range_event_hour', 'error', count(*) FROM activity WHERE event_hour NOT BETWEEN 0 AND 23",
        not_null("events", "activity", "repo_id"),
        not_null("repo_fetches", "fetches", "repo_id"),
        not_null("repo_fetches", "fetches", "fetched_at"),
        outcomes("repo_fetches", "fetches", "fetch_outcome"),
        not_null("repo_history", "history", "repo_id"),
        not_null("repo_history", "history", "valid_from"),
        "SELECT 'repo_history.history_is_contiguous', 'error', count(*) FROM offences",
        unique("latest_fetch", "state", "repo_id"),
        not_null("latest_fetch", "state", "repo_id"),
        unique("repo_daily_activity", "daily", "event_date, repo_id"),
        not_null("repo_daily_activity", "daily", "event_date"),
        not_null("repo_daily_activity", "daily", "repo_id"),
        unique("hourly_activity", "hourly", "event_date, event_hour, event_type"),
        not_null("hourly_activity", "hourly", "event_hour"),
        "SELECT 'hourly_activity.range_event_hour', 'error', count(*) FROM hourly WHERE event_hour NOT BETWEEN 0 AND 23",
        unique("repo_dim", "dim", "repo_id"),
        not_null("repo_dim", "dim", "repo_id"),
        not_null("repo_dim", "dim", "full_name"),
        outcomes("repo_dim", "dim", "latest_outcome"),
        unique("repo_snapshot_daily", "shots", "snapshot_date, repo_id"),
        not_null("repo_snapshot_daily", "shots", "stargazers_count"),
        "SELECT 'repo_snapshot_daily.range_stargazers_count', 'error', count(*) FROM shots WHERE stargazers_count < 0",
        unique("trending_repos", "trending", "trending_rank"),
        not_null("trending_repos", "trending", "trending_rank"),
        "SELECT 'trending_repos.references_repo_id', 'warn', count(*) FROM trending "
        "WHERE repo_id IS NOT NULL AND repo_id NOT IN (SELECT repo_id FROM dim)",
        unique("trending_languages", "ranked_languages", "language"),
        not_null("trending_languages", "ranked_languages", "language"),
        unique("trending_languages", "ranked_languages", "language_rank"),
        not_null("trending_languages", "ranked_languages", "language_rank"),
        unique("refresh_queue", "queue", "priority"),
        not_null("refresh_queue", "queue", "priority"),
        unique("refresh_queue", "queue", "repo_id"),
        not_null("refresh_queue", "queue", "repo_id"),
        not_null("refresh_queue", "queue", "repo_name"),
        "SELECT 'refresh_queue.accepted_reason', 'error', count(DISTINCT reason) FROM queue "
        "WHERE reason NOT IN ('trending', 'most_active', 'refresh')",
    ]
)

# For each day with a good check: the last value known of each figure up to that check.
SHOTS = """
good AS (
  SELECT *, [epoch_us(fetched_at)::VARCHAR, coalesce(etag, '')] AS turn
  FROM fetches WHERE fetch_outcome IN ('ok', 'not_modified')
),
days AS (
  SELECT repo_id, CAST(fetched_at AS DATE) AS snapshot_date, max(fetched_at) AS snapshot_at,
    arg_max(fetch_outcome, turn) = 'not_modified' AS is_carried_forward
  FROM good GROUP BY ALL
),
known AS (
  SELECT days.repo_id, snapshot_date, snapshot_at, is_carried_forward,
    arg_max(stargazers_count, turn) AS stargazers_count, arg_max(forks_count, turn) AS forks_count,
    arg_max(open_issues_count, turn) AS open_issues_count,
    arg_max(subscribers_count, turn) AS subscribers_count
  FROM days JOIN good ON good.repo_id = days.repo_id AND good.fetched_at <= snapshot_at
  GROUP BY ALL HAVING arg_max(stargazers_count, turn) IS NOT NULL
),
shots AS (
  SELECT k.*, k.stargazers_count - p.stargazers_count AS stars_change
  FROM known k ASOF LEFT JOIN known p ON k.repo_id = p.repo_id AND k.snapshot_date > p.snapshot_date
)"""

PERCENT = "round(100 * CAST({0} AS DOUBLE) / nullif({1}, 0), 1)"


def order_history(customer: str) -> str:
    return f"""
WITH log AS (SELECT *, {customer} AS customer FROM orders),
single AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer, o_orderdate ORDER BY o_orderkey DESC) AS n FROM log)
  WHERE n = 1
),
compared AS (
  SELECT *, CASE WHEN o_orderstatus IS NOT DISTINCT FROM lag(o_orderstatus) OVER w
      AND o_orderpriority IS NOT DISTINCT FROM lag(o_orderpriority) OVER w THEN 0 ELSE 1 END AS is_new
  FROM single WINDOW w AS (PARTITION BY customer ORDER BY o_orderdate)
),
numbered AS (
  SELECT *, sum(is_new) OVER (PARTITION BY customer ORDER BY o_orderdate) AS version FROM compared
),
spans AS (
  SELECT customer, version, min(o_orderdate) AS valid_from, max(o_orderdate) AS last_seen FROM numbered GROUP BY ALL
)
SELECT n.customer, strftime(n.o_orderdate, {T}) AS ordered_at, n.o_orderkey, n.o_orderstatus, n.o_orderpriority,
  strftime(s.valid_from, {T}) AS valid_from,
  strftime(lead(s.valid_from) OVER (PARTITION BY n.customer ORDER BY s.valid_from), {T}) AS valid_to
FROM numbered n JOIN spans s ON n.customer = s.customer AND n.version = s.version AND n.o_orderdate = s.last_seen"""


SILVER_COLUMNS = f"""
  event_id, CASE WHEN spoil = 4 THEN 'SparkleEvent' ELSE event_type END AS event_type, action,
  strftime(date_trunc('second', created_at), {T}) AS created_at, CAST(event_date AS VARCHAR) AS event_date,
  event_hour, actor_id, actor_login, is_bot, repo_id, repo_name, repo_owner, org_login,
  payload AS payload_json"""

LATE_DAILY = query(
    f"SELECT {DAILY_COLUMNS} FROM daily", ACTIVITY, LATE_ACTIVITY, daily_of("late_activity")
)

STAGED_HISTORY = query(
    f"""SELECT {SNAPSHOT_COLUMNS}, strftime(valid_from, {T}) AS valid_from,
  strftime(valid_to, {T}) AS valid_to, valid_to IS NULL AS is_current FROM history""",
    FETCHES,
    HISTORY,
)

ORACLE: dict[str, str] = {
    "slim_events": query(
        """
SELECT CASE WHEN spoil <> 7 THEN event_id END AS id,
  CASE WHEN spoil = 4 THEN 'SparkleEvent' ELSE event_type END AS type, actor_login,
  CASE WHEN spoil = 2 THEN 'many' ELSE CAST(repo_id AS VARCHAR) END AS repo_id, org_login,
  CASE WHEN spoil = 0 THEN 'yesterday' ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
  'true' AS public, CAST(actor_id AS VARCHAR) AS actor_id,
  CASE WHEN spoil <> 1 THEN repo_name END AS repo_name, CASE WHEN org_login IS NOT NULL THEN '9' END AS org_id,
  CASE WHEN action IS NULL THEN 'number,is_draft' ELSE 'action,number,is_draft' END AS payload_keys,
  '{' || coalesce('"action":"' || action || '",', '') || '"number":' || actor_id
    || ',"is_draft":' || (actor_id % 2 = 0) || '}' AS payload
FROM feed WHERE spoil NOT IN (3, 4, 5, 9, 10, 11, 12) AND event_type IN ('WatchEvent', 'ForkEvent')""",
        ACTIVITY,
        FEED,
    ),
    "slim_payload": query(
        """
SELECT CASE WHEN spoil NOT IN (3, 5, 7) THEN event_id END AS id, CASE WHEN spoil IN (3, 5) THEN '{}'
  ELSE '{' || coalesce('"action":"' || action || '",', '') || '"number":' || actor_id
    || ',"is_draft":' || (actor_id % 2 = 0) || '}' END AS payload
FROM feed""",
        ACTIVITY,
        FEED,
    ),
    "slimming_counts": query(
        """
SELECT count(*) FILTER (spoil NOT IN (3, 5, 9, 10, 11, 12)) AS events_in,
  count(*) FILTER (spoil NOT IN (3, 4, 5, 9, 10, 11, 12) AND event_type IN ('WatchEvent', 'ForkEvent')) AS events_out,
  count(*) FILTER (spoil IN (3, 5, 9, 10, 11, 12)) AS bad_lines
FROM feed""",
        ACTIVITY,
        FEED,
    ),
    "rescued_data": query(
        """
SELECT CASE WHEN spoil IN (3, 5, 9, 10, 11, 12) THEN '_corrupt_record,_file_path' WHEN spoil = 6 THEN 'colour,_file_path'
    WHEN spoil = 2 THEN 'repo.id,_file_path' WHEN spoil = 8 THEN 'repo.url,_file_path' ELSE '' END AS rescued_fields,
  count(*) AS rows, count(*) FILTER (spoil NOT IN (3, 5, 7)) AS rows_with_id
FROM feed GROUP BY 1""",
        ACTIVITY,
        FEED,
    ),
    "fetch_records": query(
        """
SELECT repo_id, requested_name, strftime(fetched_at, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at,
  CAST(http_status AS BIGINT) AS http_status, etag, full_name,
  CASE WHEN http_status = 200 THEN owner_login END AS owner_login,
  CASE WHEN http_status = 200 THEN homepage END AS homepage,
  CASE WHEN http_status = 200 THEN language END AS language,
  CASE WHEN http_status = 200 THEN CASE o_orderkey % 3 WHEN 0 THEN 'b,a' WHEN 1 THEN 'a,b' ELSE '' END END AS topics,
  CASE WHEN http_status = 200 THEN license_spdx_id END AS license_spdx_id,
  CASE WHEN http_status = 200 THEN is_archived END AS is_archived,
  CAST(NULL AS VARCHAR) AS parent_full_name, size_kb, stargazers_count, http_status = 200 AS has_repo,
  CASE WHEN http_status = 200 THEN repo_id END AS id, CASE WHEN http_status = 200 THEN 'User' END AS owner_type,
  CASE WHEN http_status = 200 THEN description END AS description,
  CASE WHEN http_status = 200 THEN false END AS is_fork, CASE WHEN http_status = 200 THEN false END AS is_disabled,
  CASE WHEN http_status = 200 THEN false END AS is_template,
  CASE WHEN http_status = 200 THEN 'public' END AS visibility,
  CASE WHEN http_status = 200 THEN 'main' END AS default_branch, forks_count, open_issues_count, subscribers_count,
  CASE WHEN http_status = 200 THEN strftime(repo_created_at, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
  strftime(pushed_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, strftime(pushed_at, '%Y-%m-%dT%H:%M:%SZ') AS pushed_at
FROM fetches""",
        FETCHES,
    ),
    "landing_gaps": query(
        f"""
SELECT strftime(h, {T}) AS hour, strftime(h, '%Y-%m-%d') || '-' || hour(h) AS hour_key
FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR) AS grid(h)
WHERE h NOT IN (SELECT date_trunc('hour', created_at) FROM activity WHERE event_type = 'ForkEvent')""",
        ACTIVITY,
    ),
    "landing_report": query(
        """,
hours AS (
  SELECT i, CASE WHEN i < 6 THEN '2024-01-05-' || (18 + i) ELSE '2024-01-06-' || (i - 6) END AS hour_key
  FROM range(12) AS numbers(i)
), counted AS (
  SELECT event_no % 10 AS i, count(*) FILTER (spoil NOT IN (3, 5, 9, 10, 11, 12)) AS events_in,
    count(*) FILTER (spoil NOT IN (3, 4, 5, 9, 10, 11, 12) AND event_type IN ('WatchEvent', 'ForkEvent')) AS events_out,
    count(*) FILTER (spoil IN (3, 5, 9, 10, 11, 12)) AS bad_lines
  FROM feed GROUP BY 1
)
SELECT CAST(1 AS BIGINT) AS run, hour_key, CASE WHEN c.i IS NULL THEN 'missing' ELSE 'uploaded' END AS outcome,
  events_in, events_out, bad_lines
FROM hours LEFT JOIN counted c USING (i)
UNION ALL
SELECT 2, hour_key, CASE WHEN c.i IS NULL THEN 'missing' ELSE 'skipped' END, NULL, NULL, NULL
FROM hours LEFT JOIN counted c USING (i)""",
        ACTIVITY,
        FEED,
    ).replace(")\n,\nhours", "),\nhours"),
    "landed_records": query(
        """SELECT CAST(http_status AS BIGINT) AS http_status, count(*) AS records,
  count(*) FILTER (http_status = 200) AS repositories, CAST(sum(stargazers_count) AS BIGINT) AS stars,
  '[True, False]' AS landed
FROM fetches GROUP BY http_status""",
        FETCHES,
    ),
    "silver_events": query(
        f"""
SELECT {SILVER_COLUMNS}, 'feed.json.gz' AS _source_file
FROM feed WHERE spoil NOT IN (0, 1, 2, 3, 5, 7)""",
        ACTIVITY,
        FEED,
    ),
    "streamed_events": query(
        f"SELECT {SILVER_COLUMNS} FROM feed WHERE spoil NOT IN (0, 1, 2, 3, 5, 7)", ACTIVITY, FEED
    ),
    "streamed_dedup": query(
        f"SELECT {SILVER_COLUMNS} FROM feed WHERE spoil NOT IN (0, 1, 2, 3, 5, 7)", ACTIVITY, FEED
    ),
    "streamed_violations": query(
        """
SELECT 'rows' AS rule, 'seen' AS action, count(*) AS violations FROM feed
UNION ALL SELECT 'valid_event_id', 'drop', count(*) FILTER (spoil IN (3, 5, 7)) FROM feed
UNION ALL SELECT 'valid_event_type', 'drop', count(*) FILTER (spoil IN (3, 5)) FROM feed
UNION ALL SELECT 'valid_created_at', 'drop', count(*) FILTER (spoil IN (0, 3, 5)) FROM feed
UNION ALL SELECT 'valid_repo', 'drop', count(*) FILTER (spoil IN (1, 2, 3, 5)) FROM feed
UNION ALL SELECT 'known_event_type', 'warn', count(*) FILTER (spoil IN (3, 4, 5)) FROM feed""",
        ACTIVITY,
        FEED,
    ),
    "ledger_upkeep": query(
        f"SELECT {DAILY_COLUMNS.replace(LOADED_THROUGH, '')} FROM feed_daily",
        ACTIVITY,
        FEED,
        """
kept_feed AS (
  SELECT * REPLACE (CASE WHEN spoil = 4 THEN 'SparkleEvent' ELSE event_type END AS event_type,
    date_trunc('second', created_at) AS created_at)
  FROM feed WHERE spoil NOT IN (0, 1, 2, 3, 5, 7)
)""",
        daily_of("kept_feed", "feed_daily"),
    ),
    "expectation_counts": query(
        """
SELECT 'valid_event_id' AS rule, 'drop' AS action, count(*) FILTER (spoil IN (3, 5, 7)) AS violations FROM feed
UNION ALL SELECT 'valid_event_type', 'drop', count(*) FILTER (spoil IN (3, 5)) FROM feed
UNION ALL SELECT 'valid_created_at', 'drop', count(*) FILTER (spoil IN (0, 3, 5)) FROM feed
UNION ALL SELECT 'valid_repo', 'drop', count(*) FILTER (spoil IN (1, 2, 3, 5)) FROM feed
UNION ALL SELECT 'known_event_type', 'warn', count(*) FILTER (spoil IN (3, 4, 5)) FROM feed""",
        ACTIVITY,
        FEED,
    ),
    "repo_fetches": query(
        f"""
SELECT repo_id, queued_repo_id, requested_name, strftime(fetched_at, {T}) AS fetched_at,
  CAST(http_status AS BIGINT) AS http_status, fetch_outcome, etag, full_name, stargazers_count, forks_count,
  open_issues_count, subscribers_count, size_kb, strftime(pushed_at, {T}) AS pushed_at,
  strftime(_ingested_at, {T}) AS _ingested_at
FROM fetches""",
        FETCHES,
    ),
    "repo_snapshots": query(
        f"SELECT {SNAPSHOT_COLUMNS}, strftime(fetched_at, {T}) AS fetched_at FROM fetches WHERE http_status = 200",
        FETCHES,
    ),
    "repo_history_scd2": STAGED_HISTORY,
    "streamed_history": STAGED_HISTORY,
    "history_contiguity": query("SELECT count(*) AS offences FROM offences", FETCHES, HISTORY, CHAIN),
    "order_status_history": order_history("o_custkey"),
    "skewed_history": order_history("CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END"),
    "staged_events": query(
        f"""SELECT event_id, event_type, action, strftime(created_at, {T}) AS created_at,
  CAST(event_date AS VARCHAR) AS event_date, event_hour, actor_id, actor_login, is_bot, repo_id, repo_name,
  repo_owner, org_login, strftime(_ingested_at, {T}) AS _ingested_at FROM activity""",
        ACTIVITY,
    ),
    "repo_daily_activity": query(f"SELECT {DAILY_COLUMNS} FROM daily", ACTIVITY, DAILY),
    "hourly_activity": query(
        f"""SELECT CAST(event_date AS VARCHAR) AS event_date, event_hour, event_type, events, bot_events,
  unique_actors, strftime(_loaded_through, {T}) AS _loaded_through FROM hourly""",
        ACTIVITY,
        HOURLY,
    ),
    "changed_dates_recompute": LATE_DAILY,
    "daily_activity_upkeep": LATE_DAILY,
    "full_refresh": query(
        """
SELECT 'all' AS step, count(*) AS rows, CAST(sum(total_events) AS BIGINT) AS events FROM daily
UNION ALL SELECT 'shrunk', count(*), CAST(sum(total_events) AS BIGINT) FROM daily WHERE event_date < DATE '2024-01-15'
UNION ALL SELECT 'empty', 0, 0""",
        ACTIVITY,
        DAILY,
    ),
    "latest_fetch": query(
        f"""SELECT repo_id, strftime(last_checked_at, {T}) AS last_checked_at, latest_outcome, is_available,
  last_etag, strftime(metrics_as_of, {T}) AS metrics_as_of, stargazers_count, forks_count,
  open_issues_count, subscribers_count, strftime(pushed_at, {T}) AS pushed_at FROM state""",
        FETCHES,
        STATE,
    ),
    "repo_dim": query(
        f"""SELECT {SNAPSHOT_COLUMNS},
  CAST(date_diff('day', CAST(repo_created_at AS DATE), DATE '2024-01-31') AS BIGINT) AS repo_age_days,
  strftime(valid_from, {T}) AS current_version_since, version_count, strftime(first_seen_at, {T}) AS first_seen_at,
  is_available, latest_outcome, strftime(last_checked_at, {T}) AS last_checked_at, total_stars AS stargazers_count,
  total_forks AS forks_count, issues_now AS open_issues_count, subscribers_now AS subscribers_count,
  strftime(pushed_now, {T}) AS pushed_at, strftime(metrics_as_of, {T}) AS metrics_as_of FROM dim""".replace(
            "strftime(repo_created_at", "strftime(dim.repo_created_at"
        ),
        *REPO_PARTS,
    ),
    "repo_snapshot_daily": query(
        f"""SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, repo_id, stargazers_count, forks_count,
  open_issues_count, subscribers_count, is_carried_forward, stars_change,
  strftime(snapshot_at, {T}) AS snapshot_at FROM shots""",
        FETCHES,
        SHOTS,
    ),
    "trending_repos": query("SELECT * FROM trending", *TOP_PARTS, TRENDING),
    "trending_languages": query("SELECT * FROM ranked_languages", *TOP_PARTS, LANGUAGES),
    "refresh_queue": query(
        f"""SELECT priority, repo_id, repo_name, reason, etag, strftime(last_checked_at, {T}) AS last_checked_at,
  '2024-02-01 00:00:00.000000' AS queued_at FROM queue""",
        *TOP_PARTS,
        QUEUE,
    ),
    "queue_head": query(
        "SELECT repo_id, repo_name, etag FROM queue WHERE priority <= 20", *TOP_PARTS, QUEUE
    ),
    "fetch_run_accounting": query("SELECT * FROM requests", RUNS),
    "outcome_counters": query("SELECT * FROM counters", RUNS),
    "run_health": query(
        """
SELECT run_id, CAST(coalesce(sum(requests) FILTER (outcome IN ('ok', 'not_modified', 'not_found', 'blocked', 'error')), 0) AS BIGINT) AS attempted,
  CAST(coalesce(sum(requests) FILTER (outcome = 'error'), 0) AS BIGINT) AS errors,
  2 * coalesce(sum(requests) FILTER (outcome = 'error'), 0)
    > coalesce(sum(requests) FILTER (outcome IN ('ok', 'not_modified', 'not_found', 'blocked', 'error')), 0) AS failed
FROM counters GROUP BY run_id""",
        RUNS,
    ),
    "headline_figures": query(
        f"""SELECT count(*) AS events, count(DISTINCT repo_id) AS active_repos,
  count(*) FILTER (event_type = 'WatchEvent') AS stars,
  count(*) FILTER (event_type = 'PullRequestEvent' AND action = 'merged') AS pull_requests_merged,
  count(*) FILTER (event_type = 'ReleaseEvent') AS releases,
  {PERCENT.format("count(*) FILTER (is_bot)", "count(*)")} AS bot_share_pct FROM activity""",
        ACTIVITY,
    ),
    "trending_panel": query(
        """SELECT trending_rank, repo_name, coalesce(language, 'No language') AS language, stars_in_window,
  star_growth_pct FROM trending WHERE trending_rank <= 20""",
        *TOP_PARTS,
        TRENDING,
    ),
    "breakout_repos": query(
        """SELECT trending_rank, repo_id, repo_name, language, stars_in_window, total_stars
FROM trending WHERE is_new_repo""",
        *TOP_PARTS,
        TRENDING,
    ),
    "activity_by_hour": query(
        """SELECT event_hour, count(*) FILTER (NOT is_bot) AS human_events, count(*) FILTER (is_bot) AS bot_events
FROM activity WHERE event_date IN (FROM full_days) GROUP BY event_hour""",
        ACTIVITY,
        HOURLY,
    ),
    "activity_by_day": query(
        """SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) FILTER (NOT is_bot) AS human_events,
  count(*) FILTER (is_bot) AS bot_events FROM activity WHERE event_date IN (FROM full_days) GROUP BY 1""",
        ACTIVITY,
        HOURLY,
    ),
    "pull_requests_by_day": query(
        """SELECT CAST(event_date AS VARCHAR) AS event_date,
  count(*) FILTER (event_type = 'PullRequestEvent' AND action = 'opened') AS opened,
  count(*) FILTER (event_type = 'PullRequestEvent' AND action = 'merged') AS merged
FROM activity WHERE event_date IN (FROM full_days) GROUP BY 1""",
        ACTIVITY,
        HOURLY,
    ),
    "merge_automation": query(
        f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY merged DESC, repo_id) AS merge_rank, repo_id, repo_name, merged, bot_share_pct
  FROM (
    SELECT repo_id, arg_max(repo_name, event_date) AS repo_name, CAST(sum(pull_requests_merged) AS BIGINT) AS merged,
      {PERCENT.format("sum(bot_events)", "sum(total_events)")} AS bot_share_pct
    FROM daily GROUP BY repo_id)
  WHERE merged > 0)
WHERE merge_rank <= 20""",
        ACTIVITY,
        DAILY,
    ),
    "event_mix": query(
        f"""SELECT event_type, count(*) AS events,
  {PERCENT.format("count(*)", "(SELECT count(*) FROM activity)")} AS share_pct FROM activity GROUP BY event_type""",
        ACTIVITY,
    ),
    "bot_share": query(
        f"""SELECT event_type, count(*) AS events, count(*) FILTER (is_bot) AS bot_events,
  {PERCENT.format("count(*) FILTER (is_bot)", "count(*)")} AS bot_share_pct FROM activity GROUP BY event_type""",
        ACTIVITY,
    ),
    "events_per_hour": query(
        """SELECT count(*) AS hours, min(n) AS fewest, round(avg(n), 1) AS average, max(n) AS most
FROM (SELECT count(*) AS n FROM activity GROUP BY date_trunc('hour', created_at))""",
        ACTIVITY,
    ),
    "repeated_events": "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(2 AS BIGINT) AS copies FROM events WHERE event_id % 2 = 0",
    "repository_profile": query(
        f"""SELECT count(*) AS repos, count(DISTINCT license_spdx_id) AS licenses,
  round(avg(CASE WHEN topics = '' THEN 0 ELSE 2 END), 1) AS avg_topics,
  {PERCENT.format("count(*) FILTER (language IS NULL)", "count(*)")} AS no_language_pct FROM dim""",
        *REPO_PARTS,
    ),
    "enrichment_coverage": query(
        f"""SELECT count(*) AS trending, count(dim.repo_id) AS enriched,
  {PERCENT.format("count(dim.repo_id)", "count(*)")} AS coverage_pct
FROM top LEFT JOIN dim ON top.repo_id = dim.repo_id""",
        *TOP_PARTS,
    ),
    "history_changes": query(
        """,
pairs AS (
  SELECT h.repo_id, h.language, h.topics, h.license_spdx_id, h.is_archived, lag(h.language) OVER w AS l,
    lag(h.topics) OVER w AS t, lag(h.license_spdx_id) OVER w AS s, lag(h.is_archived) OVER w AS a,
    row_number() OVER w AS n
  FROM history h WINDOW w AS (PARTITION BY h.repo_id ORDER BY h.valid_from)
)
SELECT attribute, CAST(changes AS BIGINT) AS changes FROM (
  SELECT 'language' AS attribute, count(*) FILTER (n > 1 AND language IS DISTINCT FROM l) AS changes FROM pairs
  UNION ALL SELECT 'topics', count(*) FILTER (n > 1 AND topics IS DISTINCT FROM t) FROM pairs
  UNION ALL SELECT 'license_spdx_id', count(*) FILTER (n > 1 AND license_spdx_id IS DISTINCT FROM s) FROM pairs
  UNION ALL SELECT 'is_archived', count(*) FILTER (n > 1 AND is_archived IS DISTINCT FROM a) FROM pairs
  UNION ALL SELECT unnest(['full_name', 'owner_login', 'is_disabled', 'visibility']), 0)""",
        FETCHES,
        HISTORY,
    ).replace(")\n,\npairs", "),\npairs"),
    "contract_results": query(
        CONTRACT, *TOP_PARTS, HOURLY, CHAIN, SHOTS, TRENDING, LANGUAGES, QUEUE
    ),
    "freshness": query(
        f"""
SELECT 'events' AS source, strftime(newest, {T}) AS newest, age AS age_hours,
  CASE WHEN age > 72 THEN 'error' WHEN age > 36 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(_ingested_at) AS newest, (epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max(_ingested_at))) / 3600000000.0 AS age FROM activity)
UNION ALL
SELECT 'repo_fetches', strftime(newest, {T}), age, CASE WHEN age > 48 THEN 'warn' ELSE 'pass' END
FROM (SELECT max(_ingested_at) AS newest, (epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max(_ingested_at))) / 3600000000.0 AS age FROM fetches)""",
        ACTIVITY,
        FETCHES,
    ),
}
