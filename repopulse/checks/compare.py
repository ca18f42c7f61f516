"""Runs registered queries beside their SQL counterparts and compares the rows.

`python -m repopulse.checks.compare <table folder> [query ...]`
"""

from __future__ import annotations

import math
import sys
import time

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    engine = duckdb.connect()
    for name in TABLES:
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return engine


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, engine, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides give the same columns and rows, else what differs."""
    result = query(spark, sf_dir)
    ours = _rows(result.columns, result.collect())
    cursor = engine.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    if ours == theirs:
        return None
    extra = [row for row in ours if row not in theirs][:3] if len(ours) < 20_000 else ours[:1]
    lacking = [row for row in theirs if row not in ours][:3] if len(ours) < 20_000 else theirs[:1]
    return f"{len(ours)} rows against {len(theirs)}; only here {extra}; only there {lacking}"


def main(argv: list[str]) -> int:
    from repopulse.checks.oracle import ORACLE
    from repopulse.checks.queries import registered

    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = argv[0], argv[1:]
    engine = connect(sf_dir)
    bad = 0
    for name, query in registered().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            found = differences(spark, engine, sf_dir, query, ORACLE[name])
        except Exception as error:  # a broken query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:28} {time.perf_counter() - start:6.1f}s  {found or 'same'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
