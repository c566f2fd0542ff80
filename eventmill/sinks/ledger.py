"""Which load each raw day comes from, and which load each mart day was built from.

A ledger only grows by appends: a few rows per load, and the newest entry of a subject and day is the one that holds. Comparing the
two sides shows every mart day that is older than its raw day, whichever run was meant to refresh it.

Writers need no lock. Entries are ordered by time and, where two are equal, by load id; an entry is never older than what its writer has read.
``claim`` lets at most one of several loads of a day go on. Once a ledger has MOST_FILES files, the entries that hold are written into one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.errors import ConcurrentLoadError
from eventmill.session import local_frame
from eventmill.sinks.tables import remove

LOADS_SUFFIX = "_loads"
SCHEMA = "subject string, event_date date, load_id string, entry bigint"
MOST_FILES = 64
# Files younger than this stay out of a compaction, so that no reader that has listed them loses one.
GRACE_SECONDS = 3600


def new_load_id() -> str:
    return uuid.uuid4().hex


def note(spark: SparkSession, ledger: str, entries: Mapping[str, Mapping[date, str]]) -> None:
    """Append (subject, day, load id) entries; they supersede earlier ones of the same subject and day."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({SCHEMA}) USING parquet")
    spark.catalog.refreshTable(ledger)
    files = F.count_distinct(F.when(_older_than(GRACE_SECONDS), F.col("_metadata.file_path")))
    held = spark.table(ledger).agg(F.max("entry").alias("entry"), files.alias("files")).first()
    entry = max((held.entry or 0) + 1, time.time_ns())
    rows = [(subject, day, load, entry) for subject, by_day in entries.items() for day, load in sorted(by_day.items())]
    if rows:
        local_frame(spark, rows, SCHEMA).coalesce(1).write.insertInto(ledger)
    if held.files >= MOST_FILES:
        compact(spark, ledger, GRACE_SECONDS)


def note_load(spark: SparkSession, table: str, days: Iterable[date]) -> str:
    """Give ``days`` of a raw table a load id of their own."""
    load = new_load_id()
    note(spark, table + LOADS_SUFFIX, {table: dict.fromkeys(days, load)})
    return load


def last_entries(spark: SparkSession, table: str, days: Iterable[date]) -> dict[date, int]:
    """The number of the newest entry of each of ``days``; what a load remembers when it begins."""
    found = _of_table(spark, table, days).groupBy("event_date").agg(F.max("entry").alias("entry")).collect()
    return {row.event_date: row.entry for row in found}


def claim(spark: SparkSession, table: str, days: Iterable[date], before: Mapping[date, int]) -> None:
    """Note a load of ``days`` that is about to change them, unless another one has been noted since ``before``.

    The claim is written before the others are read, so of two loads that claim at the same time at least one sees the other, and gives way.
    Both may; they never both go on. A claim that was given up makes marts of its days due again, no more.
    """
    days = sorted(set(days))
    load = note_load(spark, table, days)
    spark.catalog.refreshTable(table + LOADS_SUFFIX)
    others = _of_table(spark, table, days).where(F.col("load_id") != load).groupBy("event_date").agg(F.max("entry").alias("entry")).collect()
    taken = sorted(row.event_date for row in others if row.entry > before.get(row.event_date, 0))
    if taken:
        raise ConcurrentLoadError("another load has claimed " + ", ".join(map(str, taken)))


def _of_table(spark: SparkSession, table: str, days: Iterable[date]) -> DataFrame:
    ledger = table + LOADS_SUFFIX
    held = spark.table(ledger) if spark.catalog.tableExists(ledger) else local_frame(spark, [], SCHEMA)
    return held.where((F.col("subject") == table) & F.col("event_date").isin(list(days)))


def _holding(entries: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("load_id", "entry"), F.struct("entry", "load_id")).alias("last")
    return entries.groupBy("subject", "event_date").agg(last).select("subject", "event_date", "last.*")


def newest(spark: SparkSession, ledger: str) -> dict[str, dict[date, str]]:
    """The load id that holds for each subject and day, from one pass: one small row per day."""
    if not spark.catalog.tableExists(ledger):
        return {}
    spark.catalog.refreshTable(ledger)
    found: dict[str, dict[date, str]] = {}
    for row in _holding(spark.table(ledger)).collect():
        found.setdefault(row.subject, {})[row.event_date] = row.load_id
    return found


def loads(spark: SparkSession, table: str) -> dict[date, str]:
    return newest(spark, table + LOADS_SUFFIX).get(table, {})


def _older_than(seconds: float) -> Column:
    return F.unix_micros("_metadata.file_modification_time") < int((time.time() - seconds) * 1e6)


def compact(spark: SparkSession, ledger: str, grace_seconds: float) -> int:
    """Write what holds of a ledger's files older than ``grace_seconds`` into one and remove them; returns how many were removed.

    The new file says nothing new, so readers may see both; files that other writers add meanwhile are not touched.
    """
    spark.catalog.refreshTable(ledger)
    old = spark.table(ledger).where(_older_than(grace_seconds)).select("_metadata.file_path").distinct()
    # A compaction takes so many files at most, and the next one the rest.
    paths = [row.file_path for row in old.limit(4 * MOST_FILES).collect()]
    if len(paths) < 2:
        return 0
    held = _holding(spark.table(ledger).where(F.col("_metadata.file_path").isin(paths)))
    held.coalesce(1).write.insertInto(ledger)
    for path in paths:
        remove(spark, path)
    spark.catalog.refreshTable(ledger)
    return len(paths)
