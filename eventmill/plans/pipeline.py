"""The daily run, and the same run over many days at once.

coverage -> gate -> load -> retention -> models -> model tests; a day that fails a step goes no further. Dates come from the caller, never
from the clock, so a back-fill gives what the daily runs would have given. A back-fill is one
batch: its days share one pass of gate and load and one build per model.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.errors import MissingDayError, ModelTestError, QualityGateError, SyncFailedError
from eventmill.operators.gate import GateResult, GateRules
from eventmill.operators.delta_tests import day_failures, results_of, summed_failures, updated_duplicates, updated_orphans, value_counts
from eventmill.operators.latest import newest_per_key, updated_latest
from eventmill.operators.model_tests import DECLARED, run_model_tests
from eventmill.plans import models
from eventmill.plans.load import LoadResult, load_gated
from eventmill.schema import RETENTION_DAYS
from eventmill.session import local_frame, sized_shuffles
from eventmill.sinks import ledger
from eventmill.sinks.tables import (
    DEFAULT_RAW_TABLE,
    OFFENDERS_SUFFIX,
    REJECTS_SUFFIX,
    Buckets,
    buckets_of,
    drop_days,
    ensure_database,
    expire_days,
    forget,
    gather_days,
    materialization,
    materialize,
    namespace,
    partition_days,
    physical,
    previous,
    put_days,
    relation,
    replace_table,
)
from eventmill.sources.landing import day_coverage
from eventmill.sources.raw import landed_size

# dimension -> (its per-day sightings, key, value)
DIMENSIONS = {
    "dim_repo": ("int_repo_sightings", "repo_id", "repo_name"),
    "dim_actor": ("int_actor_sightings", "actor_id", "actor_login"),
}
# Columns of the fact that are asked for one value.
FACT_LOOKUPS = ("repo_id", "actor_id")
TEST_STATES = ("int_event_ids", "test_days", "test_duplicates", "test_orphans")
# A bucket of a state that is joined by key holds about so many rows of all kept days.
LEAST_BUCKETS, ROWS_A_BUCKET = 4, 1 << 23
# In the ledger of builds: the day has left the state.
EXPIRED = "expired"


def build_models(spark: SparkSession, raw: DataFrame, target: str = "dev", prefix: str = "") -> dict[str, DataFrame]:
    """Full build of the chain in dependency order; what each model reads is what its readers see."""
    built: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame, **layout) -> DataFrame:
        built[name] = materialize(name, df, target, prefix=prefix, **layout)
        return built[name]

    stg = add("stg_events", models.stg_events(raw))
    flattened = add("int_events_flattened", models.int_events_flattened(stg))
    add("dim_repo", models.dim_repo(flattened))
    add("dim_actor", models.dim_actor(flattened))
    fact = models.fct_events(flattened)
    if materialization(target, "fct_events") == "table":
        # The layout refresh_models() keeps up to date day by day.
        dated = gather_days(fact.withColumn("event_date", F.to_date("created_at")), "event_date")
        stored = add("fct_events", dated, partition="event_date", cluster=["event_type"], lookups=FACT_LOOKUPS)
        built["fct_events"] = stored.select(*models.FACT_COLUMNS)
        rollup = gather_days(models.agg_daily_repo_activity(built["fct_events"]), "activity_date")
        add("agg_daily_repo_activity", rollup, partition="activity_date", cluster=["repo_id"])
    else:
        add("agg_daily_repo_activity", models.agg_daily_repo_activity(add("fct_events", fact)))
    return built


class Refresh:
    """What is due in the stored states of one target, and their replacement at the cost of the changed days.

    Each state is settled by itself: the asked days, days it lacks and days loaded again since it was built (by the
    ledger's load ids) are due, days the raw table no longer has leave it.
    """

    def __init__(self, spark: SparkSession, raw_table: str, days: Iterable[date], target: str, prefix: str):
        self.spark, self.raw, self.asked, self.target, self.prefix = spark, spark.table(raw_table), set(days), target, prefix
        self.raw_days = set(partition_days(spark, raw_table))
        self.loads = ledger.loads(spark, raw_table)
        self.builds = _builds(target, prefix)
        self.built_from = ledger.newest(spark, self.builds)
        self.settled: dict[str, dict[date, str]] = {}
        for layer in ("intermediate", "marts"):
            ensure_database(spark, namespace(target, layer, prefix))

    def name(self, model: str) -> str:
        return relation(self.target, model, self.prefix)

    def of_days(self, due: Iterable[date]) -> DataFrame:
        """Flattened events of some raw days."""
        return models.int_events_flattened(self.staged_of(due))

    def staged_of(self, due: Iterable[date]) -> DataFrame:
        return models.stg_events(self.raw.where(F.col("event_date").isin(sorted(due))))

    def days(self, model: str, partition: str, cluster: list[str], build, bucketed: str | None = None, lookups: Sequence[str] = ()) -> DataFrame:
        """Settle a state that is stored by day; ``build`` gives the rows of some days."""
        table = self.name(model)
        held = set(partition_days(self.spark, table))
        built_from = self.built_from.get(model, {})
        stale = {d for d, load in self.loads.items() if built_from.get(d) != load}
        due = (self.asked | (self.raw_days - held) | stale) & self.raw_days
        if held - self.raw_days:
            drop_days(self.spark, table, sorted(held - self.raw_days))
        if due:
            rows = build(sorted(due))
            buckets = Buckets(bucketed, self._buckets(due)) if bucketed and not self.spark.catalog.tableExists(table) else None
            # Rows of a single day cannot scatter over days: no task writes more than one file. Buckets deal the rows themselves.
            put_days(gather_days(rows, partition) if len(due) > 1 and not bucketed else rows, table, partition, cluster, due, buckets, lookups)
        self.settled[model] = {d: self.loads[d] for d in due if d in self.loads}
        return self.spark.table(table)

    def _buckets(self, due: set[date]) -> int:
        """As many as the rows of all kept days will need, if they are like these; only a new table asks."""
        rows = self.raw.where(F.col("event_date").isin(sorted(due))).count() / len(due) * RETENTION_DAYS
        return max(LEAST_BUCKETS, 1 << max(0, math.ceil(rows / ROWS_A_BUCKET) - 1).bit_length())

    def whole(self, model: str, build, buckets: Buckets | None = None, shown: Sequence[str] | None = None, dealt: bool = False) -> DataFrame:
        """Settle a state over all days; ``build`` gets its stored rows (None where they are missing) and the due days, of which it may have none."""
        table, known = self.name(model), None
        if self.spark.catalog.tableExists(table):
            known = self.spark.table(physical(self.spark, table))
        built_from = self.built_from.get(model, {})
        loads = {d: self.loads.get(d, "") for d in self.raw_days}
        due = {d for d in self.raw_days if built_from.get(d) != loads[d]} | (self.asked & self.raw_days)
        left = {d for d, load in built_from.items() if load != EXPIRED} - self.raw_days
        rows = build(known, sorted(due)) if due or left or known is None else None
        if rows is not None:
            replace_table(rows, table, buckets=buckets, shown=shown, dealt=dealt and known is not None)
        self.settled[model] = {d: loads[d] for d in due} | dict.fromkeys(left, EXPIRED)
        return self.spark.table(table)

    def done(self) -> None:
        ledger.note(self.spark, self.builds, self.settled)


def refresh_models(
    spark: SparkSession,
    raw_table: str = DEFAULT_RAW_TABLE,
    days: Iterable[date] = (),
    target: str = "prod",
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Bring the mart tables up to date with the raw table at the cost of the changed days only.

    A first run builds everything, and a run after a failed one picks up what is missing or stale. The result equals a full
    build, since a fact depends on one raw row, a rollup row on one day, and a dimension on each day's sightings: its keys take
    newer values from the changed days, and only keys whose value came from a changed day are looked up in the others.
    """
    run = Refresh(spark, raw_table, days, target, prefix)
    stg = materialize("stg_events", models.stg_events(run.raw), target, "view", prefix=prefix)
    flattened = materialize("int_events_flattened", models.int_events_flattened(stg), target, "view", prefix=prefix)

    def fact_of(due: list[date]) -> DataFrame:
        return models.fct_events(run.of_days(due)).withColumn("event_date", F.to_date("created_at"))

    fact = run.days("fct_events", "event_date", ["event_type"], fact_of, lookups=FACT_LOOKUPS)

    def rollup_of(due: list[date]) -> DataFrame:
        return models.agg_daily_repo_activity(fact.where(F.col("event_date").isin(due)))

    built = {
        "stg_events": stg,
        "int_events_flattened": flattened,
        "fct_events": fact.select(*models.FACT_COLUMNS),
        "agg_daily_repo_activity": run.days("agg_daily_repo_activity", "activity_date", ["repo_id"], rollup_of),
    }
    for dimension, (state, key, value) in DIMENSIONS.items():

        def sightings_of(due: list[date], key=key, value=value) -> DataFrame:
            return models.daily_sightings(run.of_days(due), key, value)

        seen = run.days(state, "event_date", [key], sightings_of, bucketed=key)

        def dimension_of(known: DataFrame | None, due: list[date], seen=seen, key=key, value=value) -> DataFrame:
            if known is None or "created_at" not in known.columns:  # as after a full build
                return newest_per_key(seen, key, value, "created_at")
            return updated_latest(known, seen, key, value, "created_at", due, run.raw_days)

        built[dimension] = run.whole(dimension, dimension_of, buckets_of(spark, run.name(state)), (key, value), dealt=True)
    run.done()
    return built


def refresh_tests(
    spark: SparkSession,
    built: dict[str, DataFrame],
    raw_table: str = DEFAULT_RAW_TABLE,
    days: Iterable[date] = (),
    target: str = "prod",
    prefix: str = "",
) -> DataFrame:
    """The declared tests of models that ``refresh_models`` has just brought up to date: the rows of ``run_model_tests`` over all of
    history, from states that are kept by the day."""
    run = Refresh(spark, raw_table, days, target, prefix)
    fact = spark.table(run.name("fct_events"))
    by_day = [s for s in DECLARED if s.model not in DIMENSIONS]

    def ids_of(due: list[date]) -> DataFrame:
        return value_counts(fact.where(F.col("event_date").isin(due)), "event_id")

    def failures_of(due: list[date]) -> DataFrame:
        frames = {
            "stg_events": run.staged_of(due).withColumn("event_date", F.to_date("created_at")),
            "fct_events": fact.where(F.col("event_date").isin(due)),
            "agg_daily_repo_activity": built["agg_daily_repo_activity"].where(F.col("activity_date").isin(due)).withColumnRenamed("activity_date", "event_date"),
        }
        renamed = {"activity_date": "event_date"}
        parts = []
        for model, frame in frames.items():
            specs = [s for s in by_day if s.model == model and (s.not_null or s.accepted)]
            own = frame.withColumns({c: F.col(renamed[c]) for s in specs for c in [s.column] if c in renamed})
            if specs:
                parts.append(day_failures(own, "event_date", specs))
        return reduce(DataFrame.unionAll, parts)

    index = run.days("int_event_ids", "event_date", ["event_id"], ids_of, bucketed="event_id")
    duplicates = run.whole("test_duplicates", lambda known, due: updated_duplicates(index, "event_id", run.raw_days if known is None else due, known))
    kept = run.days("test_days", "event_date", ["model"], failures_of)

    def orphans_of(known: DataFrame | None, due: list[date]) -> DataFrame:
        parts = []
        for column, dimension in ((s.column, s.parent[0]) for s in by_day if s.parent):
            state, key, _ = DIMENSIONS[dimension]
            seen, named = spark.table(run.name(state)), run.name(dimension)
            own = None if known is None else known.where(F.col("column") == column).select(F.col("key").alias(column))
            found = updated_orphans(seen, column, run.raw_days if known is None else due, built[dimension], key, previous(spark, named), own)
            parts.append(found.select(F.lit(column).alias("column"), F.col(column).cast("bigint").alias("key"), "n"))
        return reduce(DataFrame.unionAll, parts)

    orphans = run.whole("test_orphans", orphans_of)
    run.done()
    unique = [(s.model, s.column) for s in by_day if s.unique]
    number = duplicates.agg(F.count(F.lit(1)).alias("failures"))
    found = [number.select(F.lit(m).alias("model"), F.lit(c).alias("column"), F.lit("unique").alias("test"), "failures") for m, c in unique]
    absent = orphans.groupBy("column").agg(F.sum("n").alias("failures"))
    found.append(absent.select(F.lit("fct_events").alias("model"), "column", F.lit("relationships").alias("test"), "failures"))
    found.append(run_model_tests(built, [s for s in DECLARED if s.model in DIMENSIONS]).drop("passed"))
    return results_of(spark, DECLARED, [summed_failures(kept), *found])


def _builds(target: str, prefix: str) -> str:
    """The ledger of what each mart day was built from."""
    return f"{namespace(target, 'marts', prefix)}.mart_builds"


def rebuild_models(
    spark: SparkSession, raw_table: str = DEFAULT_RAW_TABLE, target: str = "prod", prefix: str = ""
) -> dict[str, DataFrame]:
    """Full refresh: every model from the whole raw table."""
    for state in (*(state for state, _, _ in DIMENSIONS.values()), *TEST_STATES):
        forget(spark, relation(target, state, prefix))
    loads = ledger.loads(spark, raw_table)
    built = build_models(spark, spark.table(raw_table), target, prefix)
    if materialization(target, "fct_events") == "table":
        ledger.note(spark, _builds(target, prefix), {"fct_events": loads, "agg_daily_repo_activity": loads})
    return built


@dataclass(frozen=True)
class RunResult:
    """What a run did. ``gate``, ``load`` and ``tests`` are None where no day got that far."""

    gate: GateResult | None
    load: LoadResult | None
    models: dict[str, DataFrame]
    tests: DataFrame | None
    outcome: DataFrame


OUTCOME = "land_date date, coverage string, gate string, loaded bigint, rejected bigint, expired boolean, stopped_by string"


def run_days(
    spark: SparkSession,
    raw_dir: str,
    days: Sequence[date],
    raw_table: str = DEFAULT_RAW_TABLE,
    target: str = "dev",
    rules: GateRules = GateRules(),
    strict: bool = True,
    mode: str = "FAILFAST",
    refresh: str = "days",
    prefix: str = "",
    manifest: DataFrame | None = None,
    keep_days: int | None = RETENTION_DAYS,
    enforce: bool = True,
) -> RunResult:
    """Coverage, gate, load, retention, models and tests of ``days``.

    Days that did not land as the ``manifest`` says, or not at all, and days that fail the gate are set aside; the
    others are completed, as their own daily runs would have done, and the first failure is raised afterwards,
    with the ``outcome`` as its attribute. With ``enforce`` off nothing is raised for them.
    Offending values of days that fail the gate are kept, all of them, in ``<raw_table>_offenders``. Raw rows and
    rejects older than ``keep_days`` before the newest day expire (None: never), and the marts follow.
    ``refresh`` is ``days`` or ``full`` for mart tables; views need no refresh.
    """
    days = sorted(set(days))
    errors: list[Exception] = []
    state: dict[date, dict] = {d: {"land_date": d, "coverage": "complete", "expired": False} for d in days}

    for row in day_coverage(spark, raw_dir, days, manifest).collect():
        if not row.landed_hours or row.failed_hours:
            state[row.land_date] |= {"coverage": "incomplete" if row.landed_hours else "missing", "stopped_by": "coverage"}
    incomplete, missing = ([d for d in days if state[d]["coverage"] == kind] for kind in ("incomplete", "missing"))
    if missing:
        errors.append(MissingDayError("no landed files for " + ", ".join(map(str, missing))))
    if incomplete:
        errors.append(SyncFailedError("hours failed to arrive on " + ", ".join(map(str, incomplete))))

    gate = load = tests = None
    built: dict[str, DataFrame] = {}
    covered = [d for d in days if state[d]["coverage"] == "complete"]
    if covered:
        size = landed_size(spark, raw_dir, covered)

        def judged(verdict: GateResult) -> None:
            for day in covered:
                state[day] |= {"gate": "failed", "stopped_by": "gate"} if day in verdict.failed_days else {"gate": "passed"}
            if verdict.failures:
                errors.append(QualityGateError(verdict.failures))
                _keep_offenders(spark, verdict, raw_table)

        gate, load = load_gated(spark, raw_dir, covered, raw_table, rules, strict, mode, size, judged)
    if load is not None:
        passed = [d for d in covered if d not in gate.failed_days]
        held = partition_days(spark, raw_table)
        if keep_days is not None:
            newest = max([*days, *held])
            expired = expire_days(spark, raw_table, newest, keep_days)
            expire_days(spark, raw_table + REJECTS_SUFFIX, newest, keep_days)
            for day in set(passed) & set(expired):
                state[day]["expired"] = True
        for day in passed:
            state[day] |= {"loaded": load.loaded.get(day, 0), "rejected": load.rejected.get(day, 0)}

        # Views and full builds look at all of history, so shuffles are sized for it, not for this run's days.
        history = size.total * max(1, len(held) // len(days))
        with sized_shuffles(spark, history):
            if target != "prod":
                built = build_models(spark, spark.table(raw_table), target, prefix)
            elif refresh == "full":
                built = rebuild_models(spark, raw_table, target, prefix)
            else:
                built = refresh_models(spark, raw_table, passed, target, prefix)
            by_day = target == "prod" and refresh != "full"
            results = (refresh_tests(spark, built, raw_table, passed, target, prefix) if by_day else run_model_tests(built)).collect()
        tests = local_frame(spark, results, "model string, column string, test string, failures bigint, passed boolean")
        failed = [r for r in results if not r.passed]
        if failed:
            errors.append(ModelTestError("; ".join(f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failed)))
            for day in passed:
                state[day]["stopped_by"] = "model_tests"

    columns = [field.split()[0] for field in OUTCOME.split(", ")]
    outcome = local_frame(spark, [tuple(state[d].get(c) for c in columns) for d in days], OUTCOME)
    if enforce and errors:
        first, *others = errors
        for other in others:
            first.add_note(f"{type(other).__name__}: {other}")
        first.outcome = outcome
        raise first
    return RunResult(gate, load, built, tests, outcome)


def _keep_offenders(spark: SparkSession, gate: GateResult, raw_table: str) -> None:
    """Store every offending value of the failed days beside the raw table; a day judged again is replaced."""
    if gate.values is not None:
        ensure_database(spark, raw_table.split(".")[0])
        put_days(gate.values, raw_table + OFFENDERS_SUFFIX, "land_date", ["check", "value"], gate.failed_days)


def run_day(spark: SparkSession, raw_dir: str, day: date, **options) -> RunResult:
    return run_days(spark, raw_dir, [day], **options)
