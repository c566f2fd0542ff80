"""Latest value per key, from all rows or kept up by the day."""

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sightings(df: DataFrame, value: str, order: str, *keys: str) -> DataFrame:
    """One row per (keys, value): when that value was last seen, and ``n``, in how many rows.

    Fixed-width buffers per group stay in a hash aggregate with map-side combine, so a key that
    holds a third of all rows leaves each task as one row per value.
    """
    return df.groupBy(*keys, value).agg(F.max(order).alias(order), F.count(F.lit(1)).alias("n"))


def newest_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value, order) of the newest row of each ``key``, even when that value is null.

    Equals ``row_number() over (partition by key order by order desc) = 1``. Two values seen at the
    same instant are told apart by the value itself, so re-runs agree. Ranking happens on the
    sightings instead of the rows: full rows are never sorted.
    """
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc(), F.col(value).desc_nulls_last())
    return (
        sightings(df.where(F.col(key).isNotNull()), value, order, key)
        .withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") == 1)
        .select(key, value, order)
    )


def latest_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The ``value`` on the newest row of each ``key``."""
    return newest_per_key(df, key, value, order).select(key, value)


def updated_latest(
    state: DataFrame, seen: DataFrame, key: str, value: str, order: str, due: Collection[date], held: Collection[date]
) -> DataFrame:
    """``state`` (key, value, order) after the ``due`` days of ``seen`` were added or replaced and other days than ``held`` left.

    ``seen`` has the sightings of each day, under ``event_date``, the day of ``order``; so the day that a key's value came from is that of its
    own ``order``. Keys whose day changed are looked up in the other days again; for all other keys the due days alone can
    bring a newer value, and no other day is read. A state that is stored in buckets of the key is not shuffled.
    """
    due, held = sorted(due), sorted(held)
    gone = F.to_date(order).isin(due) | ~F.to_date(order).isin(held)
    changes = seen.where(F.col("event_date").isin(due)).select(key, value, order)
    lost = state.where(gone).select(key)
    if not lost.isEmpty():
        others = seen.where(F.col("event_date").isin([d for d in held if d not in set(due)]))
        changes = changes.unionAll(others.join(lost, key, "left_semi").select(key, value, order))
    newest = newest_per_key(changes, key, value, order).toDF(key, "new_value", "new_order")
    newer = F.col("new_order").isNotNull() & (F.col(order).isNull() | (F.col("new_order") > F.col(order)))
    merged = state.where(~gone).join(newest.hint("merge"), key, "full")
    return merged.select(
        key, F.when(newer, F.col("new_value")).otherwise(F.col(value)).alias(value), F.when(newer, F.col("new_order")).otherwise(F.col(order)).alias(order)
    )
