"""Landed newline-delimited JSON: typed reads, the hour grid, and the gzip sink."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.functions import rescue
from repopulse.functions.once import with_once
from repopulse.functions.payload import is_blank, is_one_value
from repopulse.schemas import EVENT_DDL, FETCH_DDL, QUEUE_DDL

LANDED_FILES = "*.json*"
MANIFEST = "_manifest"  # readers of landed files pass over folders with such names
HOUR_COUNTS = "events_in bigint, events_out bigint, bad_lines bigint"
HOUR_KEY = r"\d{4}-\d{2}-\d{2}-\d{1,2}(?=[./]|$)"


def typed_lines(lines: DataFrame, ddl: str) -> DataFrame:
    """Rows of `ddl` plus lineage, from text lines with `value` and `_source_file`.

    Works alike on a batch and on a stream. Blank lines are skipped; a line or a value that does
    not fit is kept in `_rescued_data` instead of failing the job.
    """
    schema = T.StructType.fromDDL(ddl)
    line = F.col("value")
    parsed = with_once(
        lines.where(~is_blank(line)),
        _typed=rescue.typed(line, schema),
        _objects=rescue.objects(line, schema),
        _keys=F.json_object_keys(line),
        _alone=is_one_value(line),
    )
    typed, keys = F.col("_typed"), F.col("_keys")
    objects = F.col("_objects")
    clean = F.col("_alone") & rescue.is_clean(keys, typed, objects, schema)
    unclean = with_once(parsed, _raw=F.when(~clean, rescue.raw_texts(line)))
    checked = with_once(unclean, _lost=rescue.misfits(F.col("_raw"), objects, typed, schema))
    leftover = rescue.rescued(line, keys, F.col("_alone"), F.col("_lost"), F.col("_source_file"))
    return checked.select(
        *[typed[name].alias(name) for name in schema.names],
        leftover.alias("_rescued_data"),
        "_source_file",
        F.current_timestamp().alias("_ingested_at"),
    )


def _text_options(reader, glob: str):
    # Dated folders are no `key=value` partitions, so files are looked up at any depth.
    return reader.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("_source_file"))


def read_lines(spark: SparkSession, path: str | list[str], glob: str = LANDED_FILES) -> DataFrame:
    return _with_origin(_text_options(spark.read, glob).load(path))


def stream_lines(
    spark: SparkSession, path: str, glob: str = LANDED_FILES, max_files: int | None = None
) -> DataFrame:
    """New files only: the checkpoint of the query remembers each file it has loaded."""
    reader = _text_options(spark.readStream, glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_origin(reader.load(path))


def spread(lines: DataFrame, tasks: int | None) -> DataFrame:
    """Lines over more tasks. A gzip file is one task however large it is; this costs a shuffle of
    the text, so it is for few large files only."""
    return lines if tasks is None else lines.repartition(tasks)


def event_rows(lines: DataFrame) -> DataFrame:
    return typed_lines(lines, EVENT_DDL)


def fetch_rows(lines: DataFrame) -> DataFrame:
    return typed_lines(lines, FETCH_DDL)


def read_queue_file(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """The first `limit` requests of a hand-made queue, one JSON object per line in fetch order.

    Order is that of the files' names and of the lines in them, however the files are split. Lines
    that name no repository take no place; the etag may be missing.
    """
    rows = spark.read.schema(QUEUE_DDL).json(path).where("repo_id IS NOT NULL")
    place = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ]
    ordered = rows.select("*", *place).orderBy("_file", "_block", "_line").limit(limit)
    return ordered.drop("_file", "_block", "_line")


# --- hours ----------------------------------------------------------------------------------------


def floor_hour(text: str) -> datetime:
    """UTC hour of an ISO date or timestamp; a text without offset is taken as UTC."""
    moment = datetime.fromisoformat(text)
    in_utc = moment.replace(tzinfo=UTC) - (moment.utcoffset() or timedelta())
    past_hour = timedelta(
        minutes=in_utc.minute, seconds=in_utc.second, microseconds=in_utc.microsecond
    )
    return in_utc - past_hour


def hour_span(
    now: datetime, lookback_hours: int, start: str | None = None, end: str | None = None
) -> tuple[datetime, datetime]:
    """Hours a landing run looks at: up to the current hour, and back far enough to heal gaps."""
    last = floor_hour(end) if end else floor_hour(now.isoformat())
    first = floor_hour(start) if start else last - timedelta(hours=lookback_hours)
    return first, last


def hour_key(hour: Column) -> Column:
    """Name of an hour: the date and the hour, not zero-padded."""
    return F.concat_ws("-", F.date_format(hour, "yyyy-MM-dd"), F.hour(hour).cast("string"))


def hour_grid(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Every hour of the half-open range, with its key. Its size is bounded by the calendar."""
    if start >= end:
        raise ValueError(f"start {start} must be before end {end}")
    step = F.expr("INTERVAL 1 HOUR")
    hours = F.sequence(F.lit(start), F.lit(end) - step, step)
    grid = spark.range(1).select(F.explode(hours).alias("hour"))
    return grid.select("hour", hour_key(F.col("hour")).alias("hour_key"))


def missing_hours(grid: DataFrame, landed: DataFrame) -> DataFrame:
    """Hours of the grid that have not landed yet. `landed` holds one column, `hour_key`."""
    return grid.join(landed.distinct(), "hour_key", "left_anti").select("hour", "hour_key")


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths below a landing folder (contents are not read); empty if there is no folder yet."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return reader.load(root).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def key_of(path: Column) -> Column:
    """Hour key in a path, whether it names a file or a folder of parts; null if there is none."""
    return F.nullif(F.regexp_extract(path, HOUR_KEY, 0), F.lit(""))


def keyed_files(spark: SparkSession, root: str) -> DataFrame:
    """Visible files below a folder with the hour they belong to."""
    files = landed_files(spark, root).where(~F.col("path").rlike(r"/[._][^/]*$"))
    keyed = files.select("path", key_of(F.col("path")).alias("hour_key"))
    return keyed.where(F.col("hour_key").isNotNull())


def day_folders(root: str, days: list[date]) -> str:
    """Pattern of the folders of some days, `date=2025-06-30` or `2025-06-30`; no other is listed."""
    names = [f"{prefix}{day.isoformat()}" for day in days for prefix in ("date=", "")]
    return f"{root}/{{{','.join(names)}}}"


def days_of(start: datetime, end: datetime) -> list[date]:
    """Calendar days that `[start, end)` touches."""
    last = (end - timedelta(microseconds=1)).date()
    return [start.date() + timedelta(days=n) for n in range((last - start.date()).days + 1)]


def landed_hours(spark: SparkSession, root: str, days: list[date]) -> DataFrame:
    """Hours of some days that have landed files, or are entered in the manifest.

    An hour may have left no file. Only the folders of those days are listed, however much has landed
    before, and of the manifest too.
    """
    if not days:
        return spark.createDataFrame([], "hour_key string")
    found = keyed_files(spark, day_folders(root, days)).select("hour_key")
    try:
        manifest = spark.read.schema("hour_key string").json(day_folders(f"{root}/{MANIFEST}", days))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return found.distinct()
    return found.union(manifest).distinct()


def enter_hours(hours: DataFrame, root: str) -> None:
    """Add landed hours with their counts to the manifest, a folder per day."""
    dated = hours.withColumn("date", F.regexp_extract("hour_key", r"^(.*)-\d+$", 1))
    dated.coalesce(1).write.mode("append").partitionBy("date").json(f"{root}/{MANIFEST}")


def landed_on(spark: SparkSession, root: str, day: date) -> bool:
    """Whether a day's folder already holds files: the guard of a once-per-day job."""
    files = landed_files(spark, day_folders(root, [day]))
    return not files.where(F.col("path").rlike(r"/[^./_][^/]*$")).isEmpty()


# --- sink -----------------------------------------------------------------------------------------


def write_ndjson(records: DataFrame, path: str, partition: list[str], mode: str = "append") -> None:
    """Gzipped JSON lines below dated folders; null fields are written out."""
    (
        records.write.mode(mode)
        .option("compression", "gzip")
        .option("ignoreNullFields", False)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .json(path)
    )
