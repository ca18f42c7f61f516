"""Activity analytics for code-hosting event feeds, written as Spark jobs."""

from repopulse.params import Params

__all__ = ["Params"]
