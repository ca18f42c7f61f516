"""Data tests and freshness checks that return their findings as rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count(offences: DataFrame) -> DataFrame:
    return offences.agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class NotNull:
    column: str
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    def offence(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InRange:
    """Inclusive bounds, either may be open; nulls pass."""

    column: str
    low: float | None = None
    high: float | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"range_{self.column}"

    def offence(self) -> Column:
        value = F.col(self.column)
        below = F.lit(False) if self.low is None else value < self.low
        above = F.lit(False) if self.high is None else value > self.high
        return below | above


@dataclass(frozen=True)
class Unique:
    """No two rows agree on all columns; rows with a null in a single column pass."""

    columns: tuple[str, ...]
    where: Column | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return "unique_" + "_".join(self.columns)

    def offence(self, rows: Column) -> Column:
        """Whether a value that so many rows have is one."""
        known = F.col(self.columns[0]).isNotNull() if len(self.columns) == 1 else F.lit(True)
        return known & (rows > 1)

    def failures(self, df: DataFrame) -> DataFrame:
        rows = df if self.where is None else df.where(self.where)
        return _count(rows.groupBy(*self.columns).count().where(self.offence(F.col("count"))))


@dataclass(frozen=True)
class Accepted:
    """Only these values occur; nulls pass. Counts distinct foreign values."""

    column: str
    values: tuple[str, ...]
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"accepted_{self.column}"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def offence(self, _: Column) -> Column:
        return F.coalesce(~F.col(self.column).isin(*self.values), F.lit(False))


@dataclass(frozen=True)
class References:
    """Each value occurs in a column of another table; nulls pass."""

    column: str
    parent: DataFrame
    parent_column: str
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"references_{self.column}"

    def failures(self, df: DataFrame) -> DataFrame:
        # Rows are counted per value first, so a frequent value is one row in the join.
        values = df.where(F.col(self.column).isNotNull()).groupBy(self.column)
        known = self.parent.select(F.col(self.parent_column).alias(self.column))
        lost = values.agg(F.count("*").alias("n")).join(known, self.column, "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@dataclass(frozen=True)
class Singular:
    """A test that is a query of its own: every row of it is an offence."""

    name: str
    rows: DataFrame
    severity: str = "error"

    def failures(self, _: DataFrame) -> DataFrame:
        return _count(self.rows)


Test = NotNull | InRange | Unique | Accepted | References | Singular


def run_tests(df: DataFrame, table: str, tests: list[Test]) -> DataFrame:
    """One row per test: name, severity and number of offences (0 = passed).

    All tests on single rows share one pass over the table, and all tests on distinct values another
    with a shuffle of the values only. A test of some rows only, or against another table, has its own.
    """
    results, alone = [], []
    of_rows = [test for test in tests if isinstance(test, (NotNull, InRange))]
    of_values = [
        t for t in tests if isinstance(t, Accepted) or (isinstance(t, Unique) and t.where is None)
    ]
    alone = [test for test in tests if test not in of_rows and test not in of_values]
    if of_rows:
        counts = df.agg(*[F.count_if(t.offence()).alias(f"n{i}") for i, t in enumerate(of_rows)])
        results.append(_results(counts, table, of_rows))
    if of_values:
        results.append(_results(_value_counts(df, of_values), table, of_values))
    for test in alone:
        results.append(_results(test.failures(df).withColumnRenamed("n", "n0"), table, [test]))
    return reduce(DataFrame.unionByName, results)


def _value_counts(df: DataFrame, tests: list[Unique | Accepted]) -> DataFrame:
    """The offences of each test in a column n0, n1, ..., from one scan and one shuffle.

    Rows are counted per set of columns and value, all sets at once; which set a count belongs to is
    in its grouping number.
    """
    sets = list(dict.fromkeys(test.columns for test in tests))
    columns = list(dict.fromkeys(name for columns in sets for name in columns))
    counted = df.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_rows")
    )

    def number(of: tuple[str, ...]) -> int:
        """Spark's number of a set: a bit for each column that is not in it, the last one lowest."""
        return sum(1 << i for i, name in enumerate(reversed(columns)) if name not in of)

    return counted.agg(
        *[
            F.count_if((F.col("_set") == number(t.columns)) & t.offence(F.col("_rows"))).alias(f"n{i}")
            for i, t in enumerate(tests)
        ]
    )


def _results(counts: DataFrame, table: str, tests: list[Test]) -> DataFrame:
    rows = [_result(f"{table}.{t.name}", t.severity, F.col(f"n{i}")) for i, t in enumerate(tests)]
    return counts.select(F.inline(F.array(*rows)))


def _result(test: str, severity: str, failures: Column) -> Column:
    return F.struct(
        F.lit(test).alias("test"), F.lit(severity).alias("severity"), failures.alias("failures")
    )


def failed(results: DataFrame) -> DataFrame:
    """Tests that must stop the run: offences of severity `error`."""
    return results.where((F.col("severity") == "error") & (F.col("failures") > 0))


def freshness(
    source: DataFrame,
    name: str,
    loaded_at: str,
    now: datetime | Column,
    warn_hours: float,
    error_hours: float | None = None,
) -> DataFrame:
    """Age of the newest row in hours, and whether that passes, warns or is an error."""
    now = now if isinstance(now, Column) else F.lit(now)
    newest = source.agg(F.max(loaded_at).alias("newest"))
    seconds = F.unix_micros(now) - F.unix_micros("newest")
    aged = newest.select("newest", (seconds / F.lit(3_600_000_000)).alias("age_hours"))
    age = F.col("age_hours")
    late = F.lit(False) if error_hours is None else age > error_hours
    status = F.when(age.isNull() | late, "error").when(age > warn_hours, "warn").otherwise("pass")
    return aged.select(F.lit(name).alias("source"), "newest", "age_hours", status.alias("status"))
