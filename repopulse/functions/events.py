"""Expressions over the fields of one event or one fetch attempt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from repopulse.schemas import FETCH_OUTCOMES

BOT_SUFFIX = "[bot]"


def is_bot(login: Column) -> Column:
    """Automated accounts carry a fixed suffix; an unknown login counts as human."""
    return F.coalesce(F.endswith(login, F.lit(BOT_SUFFIX)), F.lit(False))


def owner_of(full_name: Column) -> Column:
    """`owner` of `owner/name`; the whole text when there is no slash."""
    return F.substring_index(full_name, "/", 1)


def utc_instant(iso_text: Column) -> Column:
    """Timestamp of an ISO text, null when it is not one (a plain cast would fail the job)."""
    return iso_text.try_cast("timestamp")


def utc_date(iso_text: Column) -> Column:
    """Date as written in the text, so the session time zone cannot shift it."""
    return F.left(iso_text, F.lit(10)).try_cast("date")


def utc_hour(iso_text: Column) -> Column:
    """Hour as written in the text, so the session time zone cannot shift it."""
    return F.substring(iso_text, 12, 2).try_cast("int")


def fetch_outcome(status: Column) -> Column:
    """Name of an HTTP status; anything unexpected, null included, is `other`."""
    known = reduce(
        lambda case, item: case.when(status == item[0], item[1]),
        list(FETCH_OUTCOMES.items())[1:],
        F.when(status == 200, FETCH_OUTCOMES[200]),
    )
    return known.otherwise("other")


def counts_as(event_type: str, action: str | None = None) -> Column:
    """Number of rows of one event type, optionally with one payload action."""
    hit = F.col("event_type") == event_type
    if action is not None:
        hit = hit & (F.col("action") == action)
    return F.count_if(hit)
