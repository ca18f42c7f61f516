"""Every tunable of the queries and jobs in one immutable value."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The published defaults of the query parameters.
    trending_window_days: int = 7
    trending_top_n: int = 100
    new_repo_days: int = 30
    active_top_n: int = 800
    refresh_top_n: int = 500
    refresh_after_days: int = 7
    recheck_unavailable_days: int = 30
    # The published defaults of the landing and fetch jobs.
    lookback_hours: int = 48
    queue_limit: int = 1500
    request_cap: int = 900
    quota_reserve: int = 25

    def __post_init__(self) -> None:
        for name, value in vars(self).items():
            if value < 0:
                raise ValueError(f"{name} must not be negative, got {value}")
