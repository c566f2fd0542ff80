"""The declared tests at the cost of the changed days.

What a test needs of a day is kept by the day: how many rows each id and each key has, how many nulls, which values are not
accepted. Failures over all of history are then sums over days, or a question about the few values that a changed day
brings or takes: those meet an index that is stored in buckets of the value and is read without a shuffle.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.operators.model_tests import ColumnTests
from eventmill.session import local_frame

DAY_FAILURES = "event_date date, model string, column string, test string, value string, n bigint"
RESULTS = "model string, column string, test string, failures bigint"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(event_date, column, n): rows per non-null value and day; an index by day."""
    return df.where(F.col(column).isNotNull()).groupBy("event_date", column).agg(F.count(F.lit(1)).alias("n"))


def recount(index: DataFrame, column: str, candidates: DataFrame) -> DataFrame:
    """(column, n): rows of each candidate value over all days of an index (event_date, column, n, ...)."""
    wanted = candidates.select(F.col(column)).distinct().hint("merge")
    return index.select(column, "n").join(wanted, column, "left_semi").groupBy(column).agg(F.sum("n").alias("n"))


def updated_duplicates(index: DataFrame, column: str, due: Collection[date], known: DataFrame | None = None) -> DataFrame:
    """(column, n): values that occur more than once in any days of the index, after ``due`` days were replaced and others may have left.

    Only a value of a due day can have become a duplicate, and only a ``known`` one can have ceased to be one.
    """
    candidates = index.where(F.col("event_date").isin(sorted(due))).select(column)
    if known is not None:
        candidates = candidates.unionAll(known.select(column))
    return recount(index, column, candidates).where(F.col("n") > 1)


def updated_orphans(
    index: DataFrame, column: str, due: Collection[date], parent: DataFrame, key: str,
    before: DataFrame | None = None, known: DataFrame | None = None,
) -> DataFrame:
    """(column, n): values of the index that the parent does not have, after ``due`` days were replaced, others may have left, and the
    parent was ``before`` and is ``parent`` now.

    Two sides can make an orphan: a due day brings a value, or a value leaves the parent. Only ``known`` ones can cease to be
    one. These three kinds meet the parent; the index is read where one of them is absent from it, and for those alone.
    """
    now = parent.select(F.col(key).alias(column))
    candidates = index.where(F.col("event_date").isin(sorted(due))).select(column)
    if before is not None:
        candidates = candidates.unionAll(before.select(F.col(key).alias(column)).join(now.hint("merge"), column, "left_anti"))
    if known is not None:
        candidates = candidates.unionAll(known.select(column))
    absent = candidates.where(F.col(column).isNotNull()).distinct().join(now.hint("merge"), column, "left_anti")
    if absent.isEmpty():
        return local_frame(index.sparkSession, [], f"{column} {dict(index.dtypes)[column]}, n bigint")
    return recount(index, column, absent)


def day_failures(df: DataFrame, day: str, specs: Iterable[ColumnTests]) -> DataFrame:
    """(event_date, model, column, test, value, n): nulls per column and day, and rows per value that is not accepted.

    A day has a row for each not-null test, even where it has no null, so that the days held can be told.
    """
    parts, specs = [], list(specs)
    nulls = [s for s in specs if s.not_null]
    if nulls:
        counts = df.groupBy(F.col(day).alias("event_date")).agg(*[F.count_if(F.col(s.column).isNull()).alias(f"n{i}") for i, s in enumerate(nulls)])
        rows = [
            F.struct(F.lit(s.model).alias("model"), F.lit(s.column).alias("column"), F.lit("not_null").alias("test"), F.lit(None).cast("string").alias("value"), F.col(f"n{i}").alias("n"))
            for i, s in enumerate(nulls)
        ]
        parts.append(counts.select("event_date", F.inline(F.array(*rows))))
    for spec in specs:
        if spec.accepted:
            odd = df.where(~F.col(spec.column).isin(*spec.accepted)).groupBy(F.col(day).alias("event_date"), F.col(spec.column).cast("string").alias("value"))
            own = odd.agg(F.count(F.lit(1)).alias("n"))
            parts.append(own.select("event_date", F.lit(spec.model).alias("model"), F.lit(spec.column).alias("column"), F.lit("accepted_values").alias("test"), "value", "n"))
    return reduce(DataFrame.unionAll, parts)


def summed_failures(days: DataFrame) -> DataFrame:
    """(model, column, test, failures) of the tests that are kept by the day: nulls are summed, values counted once over all days."""
    failures = F.when(F.first("test") == "not_null", F.sum("n")).otherwise(F.count_distinct("value"))
    return days.groupBy("model", "column", "test").agg(failures.cast("bigint").alias("failures"))


def results_of(spark: SparkSession, declared: Iterable[ColumnTests], parts: Iterable[DataFrame]) -> DataFrame:
    """(model, column, test, failures, passed) of every declared test; one that no part mentions has no failure."""
    kinds = (("unique", "unique"), ("not_null", "not_null"), ("accepted", "accepted_values"), ("parent", "relationships"))
    tests = [(s.model, s.column, test) for s in declared for field, test in kinds if getattr(s, field)]
    listed = local_frame(spark, tests, "model string, column string, test string")
    found = reduce(DataFrame.unionAll, [p.select("model", "column", "test", "failures") for p in parts])
    joined = listed.join(found, ["model", "column", "test"], "left")
    counted = joined.select("model", "column", "test", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))
    return counted.withColumn("passed", F.col("failures") == 0)
