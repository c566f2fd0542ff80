"""Scans of landed files and of the raw table.

A gzip file cannot be split, so one task reads one file from start to end. Everything after the read
is narrow, so a back-fill of many days runs as one job with one task per hourly file and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmill.errors import MissingDayError
from eventmill.functions.hours import path_hour, utc
from eventmill.schema import RAW_SCHEMA, SAMPLE_SIZE
from eventmill.sources.landing import day_dir, day_files, finished_files, is_missing_path

CORRUPT = "_corrupt_record"
LIGHT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "type", "created_at")])


@dataclass(frozen=True)
class LandedSize:
    files: int
    total: int
    largest: int


def _load(reader: DataFrameReader, raw_dir: str, days: Sequence[date]) -> DataFrame:
    """All files of the days as one scan. Day folders are listed, so a long back-fill stays cheap to plan."""
    try:
        return finished_files(reader).load([day_dir(raw_dir, day) for day in days])
    except AnalysisException as error:
        if is_missing_path(error):
            raise MissingDayError(f"no landed files: {error.getMessage()}") from error
        raise


def _sizes(spark: SparkSession, raw_dir: str, days: Sequence[date]) -> dict[date, LandedSize]:
    """What each day holds, from file metadata: one row per day comes to the driver. A day without a file is an error."""
    files = _load(spark.read.format("binaryFile"), raw_dir, days)
    by_day = files.groupBy(F.to_date(path_hour(F.col("path"))).alias("day"))
    found = by_day.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total"), F.max("length").alias("largest")).collect()
    sizes = {row.day: LandedSize(row.files, row.total, row.largest) for row in found}
    empty = [day for day in days if day not in sizes]
    if empty:
        raise MissingDayError("no landed files for " + ", ".join(map(str, empty)))
    return sizes


def _land_date(days: Sequence[date]) -> Column:
    if len(days) == 1:
        return F.lit(days[0])
    return F.to_date(path_hour(F.col("_metadata.file_path")))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _lines(spark: SparkSession, raw_dir: str, days: Sequence[date], listed: bool) -> DataFrame:
    """The records of whole days as text: every line that holds more than white space is one, none other is.

    With ``listed`` the caller has already seen, by ``landed_size``, that every day has files, and they are not listed once more.
    """
    if not listed:
        _sizes(spark, raw_dir, days)
    lines = _load(spark.read.format("text"), raw_dir, days)
    return lines.where(F.col("value").rlike(r"\S")).select("value", _land_date(days).alias("land_date"))


def _parsed(schema: T.StructType, mode: str) -> Column:
    """The one parse of a line, whoever reads it: an object is a record, anything else is malformed."""
    return F.from_json("value", schema, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})


def read_events(
    spark: SparkSession, raw_dir: str, days: Sequence[date], mode: str = "FAILFAST", spread: int | None = None, listed: bool = False
) -> DataFrame:
    """Typed raw records of whole days, with the day they landed under as ``land_date``.

    ``FAILFAST`` stops at a malformed line, ``PERMISSIVE`` keeps it in ``_corrupt_record``.
    ``spread`` deals the lines out over that many tasks before they are parsed, and changes nothing else. It costs
    a shuffle of the text and pays off only where one file is far larger than the others.
    """
    lines = _lines(spark, raw_dir, days, listed)
    if spread is not None:
        lines = lines.repartition(spread)
    schema = _with_corrupt(RAW_SCHEMA) if mode == "PERMISSIVE" else RAW_SCHEMA
    return lines.select(_parsed(schema, mode).alias("event"), "land_date").select("event.*", "land_date")


def landed_size(spark: SparkSession, raw_dir: str, days: Sequence[date]) -> LandedSize:
    """How much whole days hold, from file metadata."""
    sizes = _sizes(spark, raw_dir, days).values()
    return LandedSize(sum(s.files for s in sizes), sum(s.total for s in sizes), max((s.largest for s in sizes), default=0))


def read_light(spark: SparkSession, raw_dir: str, days: Sequence[date], mode: str = "FAILFAST", listed: bool = False) -> DataFrame:
    """Only id, type and created_at of whole days; an unreadable created_at is null."""
    return (
        _lines(spark, raw_dir, days, listed)
        .select(_parsed(LIGHT_SCHEMA, mode).alias("light"), "land_date")
        .select("light.id", "light.type", F.col("light.created_at").try_cast("timestamp").alias("created_at"), "land_date")
    )


def _keys(witnesses: int | None) -> Column:
    """The top-level keys of a line; with ``witnesses``, of the first so many lines of each task only."""
    keys = F.json_object_keys("value")
    if witnesses is None:
        return keys
    # The low 33 bits of the generated id count a task's rows.
    return F.when(F.monotonically_increasing_id().bitwiseAND(0x1FFFFFFFF) < witnesses, keys)


def read_gated(
    spark: SparkSession, raw_dir: str, days: Sequence[date], witnesses: int | None = None, spread: int | None = None, listed: bool = False
) -> DataFrame:
    """What both the gate and the load need of whole days, from one scan and one parse of each line.

    The typed records of ``read_events`` with malformed lines in ``_corrupt_record``, ``unreadable`` for those of them that are no
    record at all (in the others some field has another type), and the ``keys`` of ``read_envelopes``.
    """
    lines = _lines(spark, raw_dir, days, listed)
    if spread is not None:
        lines = lines.repartition(spread)
    parsed = lines.select("value", _parsed(_with_corrupt(RAW_SCHEMA), "PERMISSIVE").alias("event"), _keys(witnesses).alias("keys"), "land_date")
    # Only malformed lines are looked at once more.
    light = _parsed(_with_corrupt(LIGHT_SCHEMA), "PERMISSIVE")[CORRUPT].isNotNull()
    unreadable = F.when(F.col(f"event.{CORRUPT}").isNotNull(), light).otherwise(False)
    return parsed.select("event.*", unreadable.alias("unreadable"), "keys", "land_date")


def read_envelopes(
    spark: SparkSession,
    raw_dir: str,
    days: Sequence[date],
    mode: str = "FAILFAST",
    witnesses: int | None = None,
    listed: bool = False,
) -> DataFrame:
    """The light columns plus the top-level keys each record really has.

    One text scan feeds every gate check. A typed read could not: it shows a column whether or not
    the records carry it. Listing a record's keys takes a second look at its text; with ``witnesses``
    only the first so many records of each task get one and the others have null keys.
    """
    return (
        _lines(spark, raw_dir, days, listed)
        .select(_parsed(LIGHT_SCHEMA, mode).alias("light"), _keys(witnesses).alias("keys"), "land_date")
        .select(
            "light.id",
            "light.type",
            F.col("light.created_at").try_cast("timestamp").alias("created_at"),
            "keys",
            "land_date",
        )
    )


def _heads(spark: SparkSession, paths: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` records of some files in hour order, from one scan; a single file is not read beyond them."""
    hour, path = path_hour(F.col("_metadata.file_path")), F.col("_metadata.file_path")
    lines = spark.read.text(list(paths)).where(F.col("value").rlike(r"\S")).select(
        hour.alias("hour"), path.alias("path"), F.monotonically_increasing_id().alias("line"), "value"
    )
    return (lines if len(paths) == 1 else lines.orderBy("hour", "path", "line")).limit(n)


def sample_lines(spark: SparkSession, raw_dir: str, day: date, n: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``n`` non-blank lines of a day in hour order, as ``value``.

    Files are opened in hour order until ``n`` lines are found: mostly the first alone, and where that is too short
    twice as many at a time, so that a day of any number of files takes a few scans.
    """
    paths = [file.path for file in day_files(spark, raw_dir, day).collect()]
    if not paths:
        raise MissingDayError(f"no landed files for {day} under {raw_dir}")
    heads, found, opened = [], 0, 0
    while opened < len(paths) and (found < n or not heads):
        some = paths[opened : 2 * opened + 1]
        heads.append(_heads(spark, some, n - found))
        opened += len(some)
        if opened < len(paths):
            found += heads[-1].count()
    return reduce(DataFrame.unionAll, heads).orderBy("hour", "path", "line").limit(n).select("value")


def within_days(df: DataFrame, start: date, end: date, partition: str = "event_date") -> DataFrame:
    """Rows created in ``[start, end)`` of a day-partitioned table.

    A filter on created_at alone would not prune the partitions derived from it, so both are given.
    """
    return df.where(
        (F.col(partition) >= F.lit(start))
        & (F.col(partition) <= F.lit(end - timedelta(days=1)))
        & (F.col("created_at") >= utc(start))
        & (F.col("created_at") < utc(end))
    )


def freshness(
    df: DataFrame, now: datetime, warn_after: timedelta | None = None, error_after: timedelta | None = None
) -> DataFrame:
    """Newest ``created_at``, its lag behind ``now`` in seconds, and ``pass``, ``warn`` or ``error``.

    Without thresholds everything passes; a source without rows has no lag and fails any threshold.
    """
    lag = F.unix_timestamp(utc(now)) - F.unix_timestamp(F.col("max_created_at").cast("timestamp"))

    def beyond(limit: timedelta | None) -> Column:
        if limit is None:
            return F.lit(False)
        return F.col("lag_seconds").isNull() | (F.col("lag_seconds") > int(limit.total_seconds()))

    return (
        df.agg(F.max("created_at").alias("max_created_at"))
        .withColumn("lag_seconds", lag)
        .withColumn("status", F.when(beyond(error_after), "error").when(beyond(warn_after), "warn").otherwise("pass"))
    )
