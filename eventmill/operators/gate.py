"""The pre-load quality gate: six checks per landed day, all from one pass.

Every number a check needs is a count over the day, so the scan ends in one hash aggregate with
fixed-width buffers and one row per day. Thresholds are compared in whole numbers: exactly one percent
passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from eventmill.errors import QualityGateError
from eventmill.schema import (
    BUFFER_HOURS,
    CRITICAL_COLUMNS,
    KNOWN_EVENT_TYPES,
    REQUIRED_COLUMNS,
    TOLERATED_PERCENT,
)
from eventmill.session import local_frame
from eventmill.sources.raw import read_envelopes, read_light
# Records of each task whose keys are listed at first; the answer does not depend on it, see run_gate().
WITNESSES = 2000


@dataclass(frozen=True)
class GateRules:
    required: tuple[str, ...] = REQUIRED_COLUMNS
    critical: tuple[str, ...] = CRITICAL_COLUMNS
    known_types: tuple[str, ...] = KNOWN_EVENT_TYPES
    tolerated_percent: int = TOLERATED_PERCENT
    buffer_hours: int = BUFFER_HOURS
    # How many offending values a failure's message shows; GateResult.values holds them all.
    shown: int = 20

    def in_range(self) -> Column:
        buffer = F.make_interval(hours=F.lit(self.buffer_hours))
        midnight = F.col("land_date").cast("timestamp")
        day = F.make_interval(days=F.lit(1))
        return F.col("created_at").between(midnight - buffer, midnight + day + buffer)

    def is_known(self) -> Column:
        return F.col("type").isin(*self.known_types)


def belongs_to_land_date() -> Column:
    """Whether the load may put a row into its day: rows without a time stay with their file's day."""
    return F.col("created_at").isNull() | (F.to_date("created_at") == F.col("land_date"))


def tallies(rules: GateRules = GateRules()) -> dict[str, Column]:
    """Every count the checks and the load need, as the condition that a counted record meets; a ``has_`` one only asks for any such record."""
    return {
        "total": F.lit(True),
        **{f"{c}_count": F.col(c).isNotNull() for c in rules.critical},
        "timed": F.col("created_at").isNotNull(),
        "in_range": rules.in_range(),
        "typed": F.col("type").isNotNull(),
        "known": rules.is_known(),
        "in_day": belongs_to_land_date(),
        **{f"has_{k}": F.array_contains("keys", k) for k in rules.required},
    }


def tallied(name: str, condition: Column) -> Column:
    """The aggregate of one of ``tallies``."""
    return F.coalesce(F.bool_or(condition), F.lit(False)) if name.startswith("has_") else F.count_if(condition)


def day_counts(envelopes: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """One row per land_date holding every count the checks and the load need."""
    return envelopes.groupBy("land_date").agg(*[tallied(name, met).alias(name) for name, met in tallies(rules).items()])


def check_rows(counts: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Day counts as one row per check. A day without records (total null) fails them all."""
    total = F.coalesce("total", F.lit(0))

    def check(name: str, column: str, judged: Column, good: Column, detail: Column) -> Column:
        judged, good = F.coalesce(judged, F.lit(0)), F.coalesce(good, F.lit(0))
        bad = judged - good
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(column).alias("column"),
            ((total > 0) & (bad * 100 <= judged * rules.tolerated_percent)).alias("success"),
            total.alias("element_count"),
            (total - judged).alias("missing_count"),
            bad.alias("unexpected_count"),
            F.when(judged > 0, bad * F.lit(100.0) / judged).alias("unexpected_percent"),
            F.when(total == 0, "empty_day").otherwise(detail).alias("detail"),
        )

    absent = [F.when(~F.coalesce(f"has_{k}", F.lit(False)), F.lit(k)) for k in rules.required]
    missing = F.concat_ws(",", *absent)
    columns = F.struct(
        F.lit("columns_present").alias("check"),
        F.lit("*").alias("column"),
        ((total > 0) & (missing == "")).alias("success"),
        total.alias("element_count"),
        F.lit(0).cast("bigint").alias("missing_count"),
        F.when(missing == "", 0).otherwise(F.size(F.split(missing, ","))).cast("bigint").alias("unexpected_count"),
        F.lit(None).cast("double").alias("unexpected_percent"),
        F.when(total == 0, "empty_day").otherwise(missing).alias("detail"),
    )
    checks = [
        columns,
        *[check("not_null", c, total, F.col(f"{c}_count"), F.lit("")) for c in rules.critical],
        check("in_range", "created_at", F.col("timed"), F.col("in_range"), F.lit("")),
        check("in_set", "type", F.col("typed"), F.col("known"), F.lit("")),
    ]
    return counts.select("land_date", F.inline(F.array(*checks)))


def _offenders(light: DataFrame, rules: GateRules) -> DataFrame:
    """(land_date, check, value) of each record that offends a value check. A null offends the null checks only."""

    def offender(check: str, column: str, good: Column) -> Column:
        return F.when(~good, F.struct(F.lit(check).alias("check"), F.col(column).cast("string").alias("value")))

    offenders = F.array(
        offender("in_range", "created_at", rules.in_range()), offender("in_set", "type", rules.is_known())
    )
    return light.select("land_date", F.inline(F.array_compact(offenders)))


def unexpected_values(light: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """(land_date, check, value, records): every offending value of every day, with the records carrying it."""
    return _offenders(light, rules).groupBy("land_date", "check", "value").agg(F.count(F.lit(1)).alias("records"))


def unexpected_samples(light: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """(land_date, check, value): the ``shown`` smallest offending values of each value check, per day, for a message.

    The rank is cut off inside each task before the shuffle, so a day of nothing but offenders costs no more than
    a good one.
    """
    by_check = Window.partitionBy("land_date", "check").orderBy("value")
    ranked = _offenders(light, rules).withColumn("rank", F.row_number().over(by_check))
    return ranked.where(F.col("rank") <= rules.shown).drop("rank")


def unlisted_keys(envelopes: DataFrame, listed: Sequence[str]) -> DataFrame:
    """(land_date, key, records): top-level keys the raw schema does not have, per day."""
    return (
        envelopes.select("land_date", F.explode("keys").alias("key"))
        .where(~F.col("key").isin(*listed))
        .groupBy("land_date", "key")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@dataclass(frozen=True)
class GateResult:
    checks: DataFrame
    counts: dict[date, Row]
    failures: list[dict]
    # Every offending value of the failed days; None when there are none.
    values: DataFrame | None = None

    @property
    def failed_days(self) -> set[date]:
        return {f["land_date"] for f in self.failures}

    def enforce(self) -> "GateResult":
        if self.failures:
            raise QualityGateError(self.failures)
        return self


def run_gate(
    spark: SparkSession,
    raw_dir: str,
    days: Sequence[date],
    rules: GateRules = GateRules(),
    mode: str = "FAILFAST",
    listed: bool = False,
) -> GateResult:
    """Check whole days; only the one row of counts per day reaches the driver.

    ``listed`` says that the caller has already seen files of every day.

    A column is present when any record has it, so the first ``WITNESSES`` records of each task normally settle
    that check. The number changes the cost only: days where a required key did not show up there have all
    their records looked at.
    """
    counts = day_counts(read_envelopes(spark, raw_dir, days, mode, witnesses=WITNESSES, listed=listed), rules)
    return judge(spark, raw_dir, days, {row.land_date: row for row in counts.collect()}, rules, mode)


def judge(
    spark: SparkSession, raw_dir: str, days: Sequence[date], rows: dict[date, Row], rules: GateRules = GateRules(), mode: str = "FAILFAST"
) -> GateResult:
    """The verdict on counts made before, by whatever scan; the files are only read for keys not yet seen and for offending values."""
    rows = dict(rows)
    unseen = [d for d, row in rows.items() if not all(row[f"has_{k}"] for k in rules.required)]
    if unseen:
        recount = day_counts(read_envelopes(spark, raw_dir, unseen, mode, listed=True), rules)
        rows.update((row.land_date, row) for row in recount.collect())
    # A day without records has no counts at all.
    names = list(tallies(rules))
    full = [tuple(rows.get(d) or (d, *[None] * len(names))) for d in days]
    schema = ", ".join(["land_date date", *[f"{name} {'boolean' if name.startswith('has_') else 'bigint'}" for name in names]])
    checks = check_rows(local_frame(spark, full, schema), rules)
    failures = [row.asDict() for row in checks.where(~F.col("success")).orderBy("land_date").collect()]
    shown = sorted({f["land_date"] for f in failures if f["unexpected_count"] and f["check"] in ("in_range", "in_set")})
    samples: dict[tuple, list[str]] = {}
    values = None
    if shown:
        light = read_light(spark, raw_dir, shown, mode, listed=True)
        values = unexpected_values(light, rules)
        for row in unexpected_samples(light, rules).collect():
            samples.setdefault((row.land_date, row.check), []).append(row.value)
    for failure in failures:
        failure["partial_unexpected"] = sorted(samples.get((failure["land_date"], failure["check"]), []))
    return GateResult(checks, rows, failures, values)
