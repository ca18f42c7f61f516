"""Column layouts of the landed files and of the tables built from them."""

from __future__ import annotations

# Names and types of the landed fields, in landed order.
EVENT_DDL = (
    "id string, type string, created_at string, public boolean, "
    "actor struct<id: bigint, login: string>, "
    "repo struct<id: bigint, name: string>, "
    "org struct<id: bigint, login: string>, "
    "payload string"
)

# The slimmed repository record.
REPO_DDL = (
    "id bigint, full_name string, owner_login string, owner_type string, description string, "
    "homepage string, language string, topics array<string>, license_spdx_id string, "
    "is_fork boolean, parent_full_name string, is_archived boolean, is_disabled boolean, "
    "is_template boolean, visibility string, default_branch string, size_kb bigint, "
    "stargazers_count bigint, forks_count bigint, open_issues_count bigint, "
    "subscribers_count bigint, created_at string, updated_at string, pushed_at string"
)

FETCH_DDL = (
    "repo_id bigint, requested_name string, fetched_at string, http_status int, etag string, "
    f"repo struct<{REPO_DDL}>"
)

# The parts of the service's repository answer that are kept.
API_REPO_DDL = (
    "id bigint, full_name string, owner struct<login: string, type: string>, description string, "
    "homepage string, language string, topics array<string>, license struct<spdx_id: string>, "
    "fork boolean, parent struct<full_name: string>, archived boolean, disabled boolean, "
    "is_template boolean, visibility string, default_branch string, size bigint, "
    "stargazers_count bigint, forks_count bigint, open_issues_count bigint, "
    "subscribers_count bigint, created_at string, updated_at string, pushed_at string"
)

QUEUE_DDL = "repo_id bigint, repo_name string, etag string"

BRONZE_LINEAGE_DDL = "_rescued_data string, _source_file string, _ingested_at timestamp"
BRONZE_EVENT_DDL = f"{EVENT_DDL}, {BRONZE_LINEAGE_DDL}"
BRONZE_FETCH_DDL = f"{FETCH_DDL}, {BRONZE_LINEAGE_DDL}"

# Event types seen so far; a new one is a warning, not lost data.
KNOWN_EVENT_TYPES = (
    "CommitCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "DiscussionEvent",
    "ForkEvent",
    "GollumEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "MemberEvent",
    "PublicEvent",
    "PullRequestEvent",
    "PullRequestReviewCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewThreadEvent",
    "PushEvent",
    "ReleaseEvent",
    "SponsorshipEvent",
    "WatchEvent",
)

# What each answer of the service means for a repository.
FETCH_OUTCOMES = {
    200: "ok",
    304: "not_modified",
    403: "blocked",
    404: "not_found",
    451: "blocked",
}
OUTCOME_NAMES = ("ok", "not_modified", "not_found", "blocked", "other")

# Attributes whose change opens a new version of a repository.
TRACKED_ATTRIBUTES = (
    "full_name",
    "owner_login",
    "language",
    "topics",
    "license_spdx_id",
    "is_archived",
    "is_disabled",
    "visibility",
)
