"""Loading landed days into the raw table."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from eventmill.errors import LoadMismatchError, StragglerError
from eventmill.operators import gate
from eventmill.operators.gate import GateResult, GateRules, belongs_to_land_date
from eventmill.sinks import ledger
from eventmill.sinks.tables import (
    DEFAULT_RAW_TABLE,
    REJECTS_SUFFIX,
    ensure_raw_table,
    gather_days,
    keep_only,
    replace_days,
    staged,
)
from eventmill.sources.raw import CORRUPT, LandedSize, landed_size, read_events, read_gated, read_light

# A gzip file above the first size is dealt out over tasks of the second before parsing.
OVERSIZED_FILE_BYTES = 1024 * 1024 * 1024
SPREAD_BYTES = 64 * 1024 * 1024
# Below this average, the scan packs several files into one task.
SHARED_TASK_FILE_BYTES = 32 * 1024 * 1024
# Up to so many days, a gated load counts each day's records while it writes them.
OBSERVED_DAYS = 31
# What becomes of a parsed line.
KEPT, STRAY, MALFORMED = "kept", "stray", "malformed"


@dataclass(frozen=True)
class DayRows:
    """How many records landed under a day and how many of them belong to it."""

    total: int
    in_day: int

    @property
    def rejected(self) -> int:
        return self.total - self.in_day


@dataclass(frozen=True)
class LoadResult:
    rows_written: int
    loaded: dict[date, int]
    rejected: dict[date, int]


def count_days(spark: SparkSession, raw_dir: str, days: Sequence[date], mode: str = "FAILFAST", listed: bool = False) -> dict[date, DayRows]:
    counted = (
        read_light(spark, raw_dir, days, mode, listed)
        .groupBy("land_date")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(belongs_to_land_date()).alias("in_day"))
    )
    return {r.land_date: DayRows(r.total, r.in_day) for r in counted.collect()}


def load_days(
    spark: SparkSession,
    raw_dir: str,
    days: Sequence[date],
    table: str = DEFAULT_RAW_TABLE,
    strict: bool = True,
    mode: str = "FAILFAST",
    counted: Mapping[date, DayRows] | None = None,
    size: LandedSize | None = None,
) -> LoadResult:
    """Replace each of ``days`` in the raw table by its landed files; other days are untouched.

    A record goes into the day it landed under, never into the day it claims: an early event of the
    next day must not replace that day's partition. Such records stop a strict load before
    anything is written; otherwise they go to the rejects table under their landing day.
    The gate has counted the days already, so a pipeline run passes ``counted`` and saves a scan.

    The parsed rows are stored in their final layout first and their counts compared with the counts made before;
    only then do the days point to them, without a second write. Whatever fails earlier leaves the old rows where they were. A tolerant load
    (``PERMISSIVE``) has no count to compare with, because only the full parse tells which lines are malformed.

    Two loads of one day at the same time never mix: whichever finds, once it has claimed its days in the ledger, that another load has
    claimed or changed one of them since it began stops with :class:`ConcurrentLoadError` and leaves the table as it is.

    Files of usual size are parsed and written by the task that reads them, without a shuffle. A file
    far above that is dealt out first, because gzip cannot be split. Files so small that a task reads
    several, of any day, are gathered by day, or each task would write a file into each day.
    """
    days = sorted(set(days))
    before = ledger.last_entries(spark, table, days)
    size = size or landed_size(spark, raw_dir, days)
    spread, gathered = _dealing(size, days)
    tolerant = mode == "PERMISSIVE"
    if not tolerant:
        counted = dict(count_days(spark, raw_dir, days, mode, listed=True) if counted is None else counted)
        rejected = {d: n.rejected for d, n in counted.items() if n.rejected}
        if strict:
            _refuse_strays(rejected)

    ensure_raw_table(spark, table)
    rejects = table + REJECTS_SUFFIX
    events = read_events(spark, raw_dir, days, mode, spread, listed=True).withColumnRenamed("land_date", "event_date")
    # The fate is a column, not a filter: a filter would be moved below the parse and parse each line again.
    parsed = events.select(*spark.table(table).columns, _fate(tolerant).alias("fate"))
    parsed = gather_days(parsed, "event_date") if gathered else parsed
    with staged(parsed, table, "fate", "event_date", cluster=["type"]) as source:
        stored = _stored(spark, source)
        loaded, strays = ({d: n for (f, d), n in stored.items() if f == wanted} for wanted in (KEPT, STRAY))
        if tolerant:
            if strict:
                _refuse_strays(strays)
        else:
            wanted = {d: DayRows(loaded.get(d, 0) + strays.get(d, 0), loaded.get(d, 0)) for d in days}
            off = [d for d in days if wanted[d] != counted.get(d, DayRows(0, 0))]
            if off:
                was = sum(counted[d].total for d in off if d in counted)
                raise LoadMismatchError(f"counted {was} records of {off}, parsed {sum(wanted[d].total for d in off)}")
            loaded = {d: loaded.get(d, 0) for d in days}
        # Noted on both sides of the change: marts built from half of it are due again.
        ledger.claim(spark, table, days, before)
        replace_days(spark, source, table, "event_date", days, fate=KEPT)
        replace_days(spark, source, rejects, "event_date", days, fate=STRAY)
        ledger.note_load(spark, table, days)
    return LoadResult(sum(loaded.values()), loaded, strays)


def _dealing(size: LandedSize, days: Sequence[date]) -> tuple[int | None, bool]:
    """Over how many tasks lines are dealt before they are parsed (None: they stay), and whether each day's rows are gathered before the write."""
    spread = math.ceil(size.total / SPREAD_BYTES) if size.largest > OVERSIZED_FILE_BYTES else None
    return spread, len(days) > 1 and (spread is not None or size.total < size.files * SHARED_TASK_FILE_BYTES)


def _fate(tolerant: bool) -> Column:
    mine = F.col("created_at").isNull() | (F.col("event_date") == F.to_date("created_at"))
    fate = F.when(mine, KEPT).otherwise(STRAY)
    return F.when(F.col(CORRUPT).isNotNull(), MALFORMED).otherwise(fate) if tolerant else fate


def load_gated(
    spark: SparkSession,
    raw_dir: str,
    days: Sequence[date],
    table: str = DEFAULT_RAW_TABLE,
    rules: GateRules = GateRules(),
    strict: bool = True,
    mode: str = "FAILFAST",
    size: LandedSize | None = None,
    judged: Callable[[GateResult], None] = lambda verdict: None,
) -> tuple[GateResult, LoadResult | None]:
    """Gate and load of days in one pass: what ``run_gate`` over ``days`` and then ``load_days`` of those that pass would do.

    Each file is read and each line parsed once. The rows are stored in their final layout, and the counts that the gate judges and the
    load reports are observed on the way, in the tasks that write, so that a stage run again after a lost executor counts nothing twice.
    Only then is the verdict given, ``judged`` called with it, and the days that pass let point to their rows; the rows of the others are
    deleted unseen. Without a passing day there is no load (None).

    Malformed lines are rare, so in ``FAILFAST`` a pass that meets one is thrown away and both steps are run by themselves: the gate stops at
    lines that are no records, the load at records of another shape, if their day passes. For more than ``OBSERVED_DAYS`` days
    the observed counts would grow too wide, and both steps are run by themselves as well; so they are where the table does not exist yet, for a
    gate that no day passes makes none. A day's counts take ``created_at`` as the load reads it:
    one given as a number is a time here, which ``run_gate`` alone counts as missing.
    """
    days = sorted(set(days))
    size = size or landed_size(spark, raw_dir, days)
    if len(days) > OBSERVED_DAYS or not spark.catalog.tableExists(table):
        return _gate_then_load(spark, raw_dir, days, table, rules, strict, mode, size, judged)
    before = ledger.last_entries(spark, table, days)
    ensure_raw_table(spark, table)
    spread, gathered = _dealing(size, days)
    records = read_gated(spark, raw_dir, days, gate.WITNESSES, spread, listed=True).withColumn("event_date", F.col("land_date"))
    columns = spark.table(table).columns
    parsed = records.select(*columns, _fate(True).alias("fate"), "unreadable", "keys", "land_date")
    parsed = gather_days(parsed, "event_date") if gathered else parsed
    fates = {f: F.col("fate") == f for f in (KEPT, STRAY, MALFORMED)}
    counted = {**gate.tallies(rules), **fates, "unreadable": F.col("unreadable")}
    seen = Observation(f"gated-{uuid.uuid4().hex[:12]}")
    measures = [
        gate.tallied(name, (F.col("land_date") == F.lit(day)) & met).alias(f"{name}@{day}") for day in days for name, met in counted.items()
    ]
    observed = parsed.observe(seen, *measures).select(*columns, "fate")
    with staged(observed, table, "fate", "event_date", cluster=["type"]) as source:
        found = seen.get
        of = {day: {name: found[f"{name}@{day}"] for name in counted} for day in days}
        broken = [day for day in days if of[day]["unreadable"]]
        if mode != "PERMISSIVE" and broken:
            keep_only(spark, source, ())
            verdict = gate.run_gate(spark, raw_dir, days, rules, mode, listed=True)
        else:
            rows = {day: Row(land_date=day, **{name: of[day][name] for name in gate.tallies(rules)}) for day in days if of[day]["total"]}
            verdict = gate.judge(spark, raw_dir, days, rows, rules, mode)
        judged(verdict)
        passed = [day for day in days if day not in verdict.failed_days]
        again = mode != "PERMISSIVE" and any(of[day][MALFORMED] for day in passed)
        if not passed or again:
            keep_only(spark, source, ())
        else:
            strays = {day: of[day][STRAY] for day in passed if of[day][STRAY]}
            if strict:
                _refuse_strays(strays)
            loaded = {day: of[day][KEPT] for day in passed if of[day][KEPT] or mode != "PERMISSIVE"}
            # Noted on both sides of the change: marts built from half of it are due again.
            ledger.claim(spark, table, passed, before)
            replace_days(spark, source, table, "event_date", passed, fate=KEPT)
            replace_days(spark, source, table + REJECTS_SUFFIX, "event_date", passed, fate=STRAY)
            ledger.note_load(spark, table, passed)
            keep_only(spark, source, [f"fate={fate}/event_date={day}" for fate in (KEPT, STRAY) for day in passed])
    if not passed:
        return verdict, None
    if again:
        return verdict, load_days(spark, raw_dir, passed, table, strict, mode, _day_rows(verdict, passed))
    return verdict, LoadResult(sum(loaded.values()), loaded, strays)


def _day_rows(verdict: GateResult, days: Sequence[date]) -> dict[date, DayRows]:
    return {d: DayRows(verdict.counts[d].total, verdict.counts[d].in_day) for d in days}


def _gate_then_load(spark, raw_dir, days, table, rules, strict, mode, size, judged) -> tuple[GateResult, LoadResult | None]:
    verdict = gate.run_gate(spark, raw_dir, days, rules, mode, listed=True)
    judged(verdict)
    passed = [d for d in days if d not in verdict.failed_days]
    if not passed:
        return verdict, None
    return verdict, load_days(spark, raw_dir, passed, table, strict, mode, _day_rows(verdict, passed), size if passed == days else None)


def _refuse_strays(rejected: Mapping[date, int]) -> None:
    if rejected:
        detail = ", ".join(f"{d}: {n}" for d, n in sorted(rejected.items()))
        raise StragglerError(f"records of another day in the landed files ({detail})")


def _stored(spark: SparkSession, source: str) -> dict[tuple[str, date], int]:
    """Rows per fate and day, from file footers."""
    held = spark.table(source).groupBy("fate", "event_date").count()
    return {(row.fate, row.event_date): row["count"] for row in held.collect()}


def quarantine(spark: SparkSession, raw_dir: str, days: Sequence[date]) -> DataFrame:
    """Malformed lines of whole days, as (land_date, line)."""
    events = read_events(spark, raw_dir, days, mode="PERMISSIVE")
    return events.select("land_date", F.col(CORRUPT).alias("line")).where(F.col("line").isNotNull())
