"""Row expectations: named predicates that drop rows or only count violations."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectations:
    """Rules as SQL predicates over the output columns. A null result is a violation."""

    required: dict[str, str]
    expected: dict[str, str] = field(default_factory=dict)

    def actions(self) -> dict[str, str]:
        """What each rule does to a row that breaks it."""
        return {**dict.fromkeys(self.required, "drop"), **dict.fromkeys(self.expected, "warn")}

    def violations(self) -> list[Column]:
        """Aggregates: how many rows break each rule."""
        rules = {**self.required, **self.expected}
        return [F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()]

    def keep(self, df: DataFrame) -> DataFrame:
        """Rows for which every required rule holds."""
        return df.where(reduce(Column.__and__, map(_holds, self.required.values()), F.lit(True)))

    def watch(self, df: DataFrame, counts: Observation) -> DataFrame:
        """`keep`, with the violations per rule counted in passing.

        The counts ride on the query itself: no second scan.
        """
        return self.keep(df.observe(counts, F.count("*").alias("rows"), *self.violations()))

    def counts(self, df: DataFrame) -> DataFrame:
        """One row per rule with its action and number of violations, from a single pass."""
        per_rule = [
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(action).alias("action"),
                F.col(rule).alias("violations"),
            )
            for rule, action in self.actions().items()
        ]
        totals = df.agg(*self.violations())
        return totals.select(F.inline(F.array(*per_rule)))


def _holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))
