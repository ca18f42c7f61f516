"""Raw feed lines and raw service answers reduced to what the tables use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.once import with_once
from repopulse.functions.payload import VARIANT_MAP, is_blank, is_json_object, scalars
from repopulse.schemas import API_REPO_DDL, REPO_DDL

# Identity objects keep these members, whatever their JSON type.
RAW_EVENT_DDL = (
    "id variant, type string, created_at variant, public variant, "
    f"actor {VARIANT_MAP}, repo {VARIANT_MAP}, org {VARIANT_MAP}, payload {VARIANT_MAP}"
)


def _members(source: Column, *names: str) -> Column:
    return F.struct(*[source[name].alias(name) for name in names])


def slim_events(lines: DataFrame, event_types: list[str] | None = None) -> DataFrame:
    """Envelope and scalar payload of each raw event, from text lines in `value`.

    Nested payload objects are dropped. Blank and broken lines give no row. An empty or missing
    list of types keeps all. Other columns of `lines` are passed on.
    """
    passed_on = [c for c in lines.columns if c != "value"]
    good = lines.where(is_json_object(F.col("value")))
    parsed = with_once(good, e=F.from_json("value", RAW_EVENT_DDL))
    event = parsed.select(*passed_on, "e.*")
    if event_types:
        event = event.where(F.col("type").isin(*event_types))
    has_org = F.size("org") > 0
    return event.select(
        *passed_on,
        "id",
        "type",
        "created_at",
        "public",
        _members(F.col("actor"), "id", "login").alias("actor"),
        _members(F.col("repo"), "id", "name").alias("repo"),
        F.when(has_org, _members(F.col("org"), "id", "login")).alias("org"),
        scalars(F.col("payload")).alias("payload"),
    )


def slimming_counts(lines: DataFrame, event_types: list[str] | None = None) -> DataFrame:
    """Lines in, lines kept and bad lines, from one pass over the raw text."""
    text = F.col("value")
    kept_type = F.lit(True)
    if event_types:
        kept_type = F.coalesce(F.get_json_object(text, "$.type").isin(*event_types), F.lit(False))
    good = is_json_object(text)
    return lines.where(~is_blank(text)).agg(
        F.count_if(good).alias("events_in"),
        F.count_if(good & kept_type).alias("events_out"),
        F.count_if(~good).alias("bad_lines"),
    )


def slim_repository(answer: Column) -> Column:
    """The kept part of a repository answer, given as a struct of API_REPO_DDL."""
    renamed = {
        "owner_login": answer["owner"]["login"],
        "owner_type": answer["owner"]["type"],
        "homepage": F.nullif(answer["homepage"], F.lit("")),
        "topics": F.coalesce(answer["topics"], F.array().cast("array<string>")),
        "license_spdx_id": answer["license"]["spdx_id"],
        "is_fork": answer["fork"],
        "parent_full_name": answer["parent"]["full_name"],
        "is_archived": answer["archived"],
        "is_disabled": answer["disabled"],
        "size_kb": answer["size"],
    }
    names = [field.split()[0] for field in REPO_DDL.split(", ")]
    return F.struct(*[renamed.get(name, answer[name]).alias(name) for name in names])


def parse_bodies(responses: DataFrame) -> DataFrame:
    """A response log with the JSON text in `body` replaced by its kept members."""
    texts = responses.withColumnRenamed("body", "_text")
    return with_once(texts, body=F.from_json("_text", API_REPO_DDL)).drop("_text")


def fetch_records(responses: DataFrame) -> DataFrame:
    """Landed records from a response log.

    The log holds (repo_id, requested_name, fetched_at, http_status, sent_etag, response_etag,
    body). An answer without its own ETag keeps the one that was sent, and only a 200 carries a
    repository.
    """
    found = (F.col("http_status") == 200) & F.col("body").isNotNull()
    return responses.select(
        "repo_id",
        "requested_name",
        "fetched_at",
        "http_status",
        F.coalesce(F.nullif("response_etag", F.lit("")), "sent_etag").alias("etag"),
        F.when(found, slim_repository(F.col("body"))).alias("repo"),
    )
