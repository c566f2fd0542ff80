"""What has landed, what should have, and what to fetch next.

The transfer itself happens outside Spark. ``manifest(hour, exists, content_length)`` describes the
remote side; listings read file metadata only, never content.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from eventmill.errors import SyncFailedError
from eventmill.functions.hours import explode_hours, hour_path, path_hour
from eventmill.session import local_frame

STATUSES = ("downloaded", "skipped", "not_found", "failed")


def day_dir(raw_dir: str, day: date) -> str:
    return f"{raw_dir.rstrip('/')}/{day:%Y/%m/%d}"


def finished_files(reader: DataFrameReader) -> DataFrameReader:
    """Only finished files: a ``.part`` leftover does not match. An hour may be a folder of parts."""
    return reader.option("pathGlobFilter", "*.json.gz").option("recursiveFileLookup", "true")


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _listing(spark: SparkSession, path: str) -> DataFrame:
    try:
        files = finished_files(spark.read.format("binaryFile")).load(path).select("path", "length")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        files = local_frame(spark, [], "path string, length bigint")
    return files.withColumn("hour", path_hour(F.col("path"))).where(F.col("hour").isNotNull())


def _folders(raw_dir: str, days: Sequence[date]) -> str:
    """One path for the folders of all ``days``: those that do not exist are no error, and no other is listed."""
    return f"{raw_dir.rstrip('/')}/{{{','.join(f'{day:%Y/%m/%d}' for day in sorted(set(days)))}}}"


def landed_hours(spark: SparkSession, raw_dir: str, days: Sequence[date] = ()) -> DataFrame:
    """(hour, path, length) of what landed under ``days``, or under any day; nothing where no folder exists yet.

    With ``days`` only their folders are listed, in one pass, so a plan for a day does not look at the history.
    """
    return (
        _listing(spark, _folders(raw_dir, days) if days else raw_dir)
        .groupBy("hour")
        .agg(F.min("path").alias("path"), F.sum("length").alias("length"))
    )


def days_files(spark: SparkSession, raw_dir: str, days: Sequence[date]) -> DataFrame:
    """(day, hour, path, length) of the files of ``days`` in order of day and numeric hour, from one listing."""
    return (
        _listing(spark, _folders(raw_dir, days))
        .select(F.to_date("hour").alias("day"), F.hour("hour").alias("hour"), "path", "length")
        .orderBy("day", "hour", "path")
    )


def day_files(spark: SparkSession, raw_dir: str, day: date) -> DataFrame:
    """(hour, path, length) of one day's files in numeric hour order; empty for a missing day."""
    return days_files(spark, raw_dir, [day]).drop("day")


def sync_plan(
    grid: DataFrame, landed: DataFrame, manifest: DataFrame, raw_dir: str = "raw", force: bool = False
) -> DataFrame:
    """Per hour of the grid: ``skipped``, ``refetch``, ``fetch`` or ``not_found``, and its bytes."""
    have = landed.select("hour", F.col("length").alias("landed_length"))
    remote = manifest.select("hour", F.col("exists").alias("published"), "content_length")
    is_landed = F.lit(False) if force else F.col("landed_length").isNotNull()
    size = F.col("content_length")
    status = (
        F.when(~F.coalesce("published", F.lit(False)), "not_found")
        .when(~is_landed, "fetch")
        .when(size.isNull(), "not_found")
        .when(F.col("landed_length") == size, "skipped")
        .otherwise("refetch")
    )
    return (
        grid.select("hour")
        .join(have, "hour", "left")
        .join(remote, "hour", "left")
        .select("hour", hour_path(F.col("hour"), raw_dir).alias("path"), status.alias("status"), size)
        .select(
            "hour",
            "path",
            "status",
            F.when(F.col("status") != "not_found", F.coalesce(size, F.lit(0))).otherwise(0).alias("bytes"),
        )
    )


def day_coverage(
    spark: SparkSession, raw_dir: str, days: Sequence[date], manifest: DataFrame | None = None
) -> DataFrame:
    """(land_date, landed_hours, failed_hours) of each asked day after the copy step.

    An hour failed when the manifest has it and it did not land, or landed with another length. Without a manifest no
    hour is known to be owed, so only a day without any file stands out.
    """
    landed = landed_hours(spark, raw_dir, days)
    asked = local_frame(spark, [(day,) for day in sorted(set(days))], "land_date date")
    counted = landed.groupBy(F.to_date("hour").alias("land_date")).agg(F.count(F.lit(1)).alias("landed_hours"))
    covered = asked.join(counted, "land_date", "left").fillna(0, ["landed_hours"])
    if manifest is None:
        return covered.withColumn("failed_hours", F.lit(0).cast("bigint"))
    bounds = asked.select(F.col("land_date").cast("timestamp").alias("start"), F.date_add("land_date", 1).cast("timestamp").alias("end"))
    owed = sync_plan(explode_hours(bounds), landed, manifest).where(F.col("status").isin("fetch", "refetch"))
    failed = owed.groupBy(F.to_date("hour").alias("land_date")).agg(F.count(F.lit(1)).alias("failed_hours"))
    return covered.join(failed, "land_date", "left").fillna(0, ["failed_hours"])


def sync_result(plan: DataFrame, landed_after: DataFrame) -> DataFrame:
    """The plan after the copy step: planned hours are now ``downloaded`` or ``failed``."""
    after = landed_after.select("hour", F.col("length").alias("arrived"))
    planned = F.col("status").isin("fetch", "refetch")
    # A refetch that did not happen leaves the old file, recognisable by its old size.
    stale = (F.col("status") == "refetch") & (F.col("arrived") != F.col("bytes"))
    missing = planned & (F.col("arrived").isNull() | stale)
    return plan.join(after, "hour", "left").select(
        "hour",
        "path",
        F.when(missing, "failed").when(planned, "downloaded").otherwise(F.col("status")).alias("status"),
        F.when(missing, 0).when(planned, F.col("arrived")).otherwise(F.col("bytes")).alias("bytes"),
    )


def sync_summary(result: DataFrame) -> DataFrame:
    """One row: hours requested, a count per status (zero when absent) and total bytes."""
    return result.agg(
        F.count(F.lit(1)).alias("hours_requested"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )


def require_complete(summary: DataFrame) -> dict:
    """The summary row as a dict; raises when any hour failed."""
    row = summary.first().asDict()
    if row["failed"]:
        raise SyncFailedError(f"{row['failed']} hour(s) failed to arrive")
    return row
