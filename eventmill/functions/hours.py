"""UTC hours and the names of landed files."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.schema import PUBLISH_DELAY_HOURS, WINDOW_HOURS

# File naming. The hour has no leading zero.
PATH_FORMAT = "yyyy/MM/dd/H"
KEY_FORMAT = "yyyy-MM-dd-H"
SUFFIX = ".json.gz"

# An hour is a file ``H.json.gz``, or a folder of that name holding parts of it.
_PATH_HOUR = r"(\d{4}/\d{2}/\d{2}/\d{1,2})\.json\.gz"


def utc(moment: datetime | date | str) -> Column:
    """A timestamp literal; naive moments are taken as UTC."""
    if isinstance(moment, datetime) and moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    text = moment if isinstance(moment, str) else moment.isoformat()
    return F.lit(text).cast("timestamp")


def hour_path(hour: Column, root: str = "raw") -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.date_format(hour, PATH_FORMAT), F.lit(SUFFIX))


def hour_key(hour: Column) -> Column:
    return F.concat(F.date_format(hour, KEY_FORMAT), F.lit(SUFFIX))


def path_hour(path: Column) -> Column:
    """Hour named by a landed path; null for any other path."""
    return F.try_to_timestamp(F.regexp_extract(path, _PATH_HOUR, 1), F.lit(PATH_FORMAT))


def explode_hours(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every hour in ``[start, end)`` of each row, both bounds cut to the hour."""
    hour = F.expr("interval 1 hour")
    return (
        bounds.select(
            F.date_trunc("hour", F.col(start)).alias("first"),
            (F.date_trunc("hour", F.col(end)) - hour).alias("last"),
        )
        .where(F.col("first") <= F.col("last"))
        # greatest() keeps the range legal even where the filter is applied after it.
        .select(F.explode(F.sequence("first", F.greatest("first", "last"), hour)).alias("hour"))
    )


def hour_grid(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    return explode_hours(spark.range(1).select(utc(start).alias("start"), utc(end).alias("end")))


def trailing_window(now: datetime, hours: int = WINDOW_HOURS) -> tuple[datetime, datetime]:
    """The default window: ends when the feed is surely published, lasts ``hours``."""
    end = now - timedelta(hours=PUBLISH_DELAY_HOURS)
    return end - timedelta(hours=hours), end
