"""Declarative tests over finished models: unique, not_null, accepted_values, relationships.

Each test reduces its model to a count of failing items; zero passes. Null keys are never duplicates
and never orphans.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.schema import KNOWN_EVENT_TYPES


@dataclass(frozen=True)
class ColumnTests:
    """The tests declared on one column of a model."""

    model: str
    column: str
    unique: bool = False
    not_null: bool = False
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None


# The declared tests, fifteen in all.
DECLARED = (
    ColumnTests("stg_events", "event_id", unique=True, not_null=True),
    ColumnTests("stg_events", "event_type", not_null=True, accepted=KNOWN_EVENT_TYPES),
    ColumnTests("stg_events", "created_at", not_null=True),
    ColumnTests("dim_repo", "repo_id", unique=True, not_null=True),
    ColumnTests("dim_actor", "actor_id", unique=True, not_null=True),
    ColumnTests("fct_events", "event_id", unique=True, not_null=True),
    ColumnTests("fct_events", "repo_id", parent=("dim_repo", "repo_id")),
    ColumnTests("fct_events", "actor_id", parent=("dim_actor", "actor_id")),
    ColumnTests("agg_daily_repo_activity", "activity_date", not_null=True),
    ColumnTests("agg_daily_repo_activity", "repo_id", not_null=True),
)


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """(column, n): non-null values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def orphan_values(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """(column, n): non-null child keys absent from the parent, with the child rows behind each.

    Child rows are combined per key first, so a hot key reaches the join as a single row, and the
    join reuses the grouping's partitioning.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(key).alias(column))
    return keys.join(known, column, "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted) -> DataFrame:
    """(column, n): non-null values outside the accepted set."""
    return df.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _count_over(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def _results(frame: DataFrame, model: str, tests: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate over ``frame`` turned into one row per (column, test, failures)."""
    totals = frame.agg(*[failures.alias(f"f{i}") for i, (_, _, failures) in enumerate(tests)])
    rows = [
        F.struct(F.lit(column).alias("column"), F.lit(test).alias("test"), F.col(f"f{i}").alias("failures"))
        for i, (column, test, _) in enumerate(tests)
    ]
    return totals.select(F.lit(model).alias("model"), F.inline(F.array(*rows)))


def _by_value(df: DataFrame, spec: ColumnTests) -> DataFrame:
    """Tests that look at distinct values share one grouping, nulls being one of its groups."""
    column = F.col(spec.column)
    tests = []
    if spec.unique:
        tests.append((spec.column, "unique", F.count_if(column.isNotNull() & (F.col("n") > 1))))
    if spec.not_null:
        tests.append((spec.column, "not_null", _count_over(F.when(column.isNull(), F.col("n")))))
    if spec.accepted:
        tests.append((spec.column, "accepted_values", F.count_if(~column.isin(*spec.accepted))))
    return _results(df.groupBy(spec.column).agg(F.count(F.lit(1)).alias("n")), spec.model, tests)


def run_model_tests(models: Mapping[str, DataFrame], declared=DECLARED) -> DataFrame:
    """(model, column, test, failures, passed), one row per declared test, as one Spark job."""
    parts = []
    plain: dict[str, list] = {}
    for spec in declared:
        df = models[spec.model]
        if spec.unique or spec.accepted:
            parts.append(_by_value(df, spec))
        elif spec.not_null:
            plain.setdefault(spec.model, []).append(
                (spec.column, "not_null", F.count_if(F.col(spec.column).isNull()))
            )
        if spec.parent:
            parent, key = spec.parent
            orphans = orphan_values(df, spec.column, models[parent], key)
            parts.append(_results(orphans, spec.model, [(spec.column, "relationships", _count_over(F.col("n")))]))
    parts += [_results(models[model], model, tests) for model, tests in plain.items()]
    return reduce(DataFrame.unionAll, parts).withColumn("passed", F.col("failures") == 0)
