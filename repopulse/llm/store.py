"""Intermediate tables in the folder the cluster names, so that a lost executor loses no work."""

from __future__ import annotations

from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.session import shared_dir

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WRITING = {SHUFFLES_GO: "true", BATCH_BYTES: str(4 << 20)}

_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and go on from its files; options are the Parquet writer's.

    Each call takes a new folder below `<spark.checkpoint.dir>/llm`; the folder's owner expires them.
    The shuffle files behind the table are of no more use then, and go when the write is done. Rows go
    to Python in batches of a few MB, however long their texts, so that workers stay small. The
    session's own settings are put back.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid4().hex}"
    before = {name: spark.conf.get(name, None) for name in WRITING}
    for name, value in WRITING.items():
        spark.conf.set(name, value)
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    table = spark.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more; whatever is made of them must be stored itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_places.pop(table))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(*keys: str) -> Column:
    """A well mixed number from columns, for salts and blocks."""
    return F.xxhash64(*keys)


def text_input(docs: DataFrame, id_col: str, text_col: str, id_name: str = "doc_id") -> DataFrame:
    """Only the id (bigint) and the text (null: empty) of a table, whatever else it holds."""
    return docs.select(
        F.col(id_col).cast("bigint").alias(id_name),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def unused(columns: list[str], n: int) -> list[str]:
    """Column names that a table does not have yet."""
    taken = {c.lower() for c in columns}
    names = (f"_{i}" for i in range(len(taken) + n))
    return [name for name in names if name not in taken][:n]
