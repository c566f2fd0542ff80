"""Day-partitioned tables: create, replace whole days, expire, and materialize models.

Rows are written once, where they stay. What changes afterwards is a pointer in the catalog: a day is the location of its partition, a rebuilt
model the version that its name stands for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.schema import RAW_SCHEMA, RETENTION_DAYS

DEFAULT_RAW_TABLE = "raw_events.events"
REJECTS_SUFFIX = "_rejects"
OFFENDERS_SUFFIX = "_offenders"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def ensure_raw_table(spark: SparkSession, table: str = DEFAULT_RAW_TABLE) -> None:
    """The raw table, and one of equal shape for rows a load turned away."""
    ensure_database(spark, table.split(".")[0])
    columns = RAW_SCHEMA.toDDL()
    for name in (table, table + REJECTS_SUFFIX):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, event_date DATE) "
            "USING parquet PARTITIONED BY (event_date)"
        )


# ---- versions: what a name stands for is one pointer --------------------------------------------------


def physical(spark: SparkSession, table: str) -> str:
    """The stored table behind a name: the one a versioned model points to, or the table itself."""
    return _pointer(spark, table).get("stored", table)


def _pointer(spark: SparkSession, table: str) -> dict[str, str]:
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return {}
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def point(spark: SparkSession, table: str, version: str, columns: Sequence[str] | None = None) -> None:
    """Let a name stand for ``version`` from now on.

    A reader sees the old rows up to the swap and the new ones after it. The version before stays for readers that
    have begun; the one before that is dropped.
    """
    before = _pointer(spark, table)
    if spark.catalog.tableExists(table) and not before:
        spark.sql(f"DROP TABLE {table}")
    kept = {"stored": version} | ({"previous": before["stored"]} if before else {})
    properties = ", ".join(f"'{key}' = '{value}'" for key, value in kept.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({properties}) AS SELECT {', '.join(columns or ['*'])} FROM {version}")
    if "previous" in before:
        spark.sql(f"DROP TABLE IF EXISTS {before['previous']}")


def previous(spark: SparkSession, table: str) -> DataFrame | None:
    """The version that a name stood for before."""
    name = _pointer(spark, table).get("previous")
    return spark.table(name) if name else None


def forget(spark: SparkSession, table: str) -> None:
    """Drop a model with all its versions."""
    pointer = _pointer(spark, table)
    if not pointer:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        return
    spark.sql(f"DROP VIEW {table}")
    for version in (pointer["stored"], pointer.get("previous")):
        if version:
            spark.sql(f"DROP TABLE IF EXISTS {version}")


# ---- days -------------------------------------------------------------------------------------------


def partition_days(spark: SparkSession, table: str) -> list[date]:
    """Days a table holds, from the catalog."""
    if not spark.catalog.tableExists(table):
        return []
    return sorted(
        date.fromisoformat(row.partition.rsplit("=", 1)[1])
        for row in spark.sql(f"SHOW PARTITIONS {physical(spark, table)}").collect()
    )


def drop_days(spark: SparkSession, table: str, days: Iterable[date]) -> None:
    table = physical(spark, table)
    key = next(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    specs = ", ".join(f"PARTITION ({key} = DATE'{d.isoformat()}')" for d in days)
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def expire_days(spark: SparkSession, table: str, as_of: date, keep_days: int = RETENTION_DAYS) -> list[date]:
    """Drop partitions older than ``as_of`` less the retention; returns the dropped days."""
    cutoff = as_of - timedelta(days=keep_days)
    expired = [d for d in partition_days(spark, table) if d < cutoff]
    drop_days(spark, table, expired)
    return expired


@dataclass(frozen=True)
class Buckets:
    """Rows of a table dealt to so many files per day by one column, sorted by it: joins and groupings on it need no shuffle."""

    column: str
    number: int


def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {physical(spark, table)}").collect()}
    if "Num Buckets" not in described:
        return None
    return Buckets(described["Bucket Columns"].strip("[]`"), int(described["Num Buckets"]))


#: A Bloom filter's largest size in a row group's column; the writer takes the smallest of a few sizes that fits the column's distinct values.
BLOOM_BYTES = 1 << 20


def _laid_out(
    df: DataFrame, partitions: Sequence[str], cluster: Sequence[str], buckets: Buckets | None, dealt: bool = False, lookups: Sequence[str] = ()
):
    """A writer of rows ordered by day inside each task, so that a task writing several days keeps one file open at a time, and by the
    cluster columns inside a day, so that row groups can be skipped. ``lookups`` are columns that are asked for single values: each row group
    keeps a Bloom filter of theirs, and one that cannot hold the value is not read. ``dealt`` rows come from a join of equal buckets and are not shuffled."""
    if buckets:
        df, cluster = df if dealt else df.repartition(buckets.number, buckets.column), [buckets.column]
    order = [*partitions, *cluster]
    writer = (df.sortWithinPartitions(*order) if order else df).write.format("parquet")
    for column in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if lookups:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", str(BLOOM_BYTES))
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.bucketBy(buckets.number, buckets.column).sortBy(buckets.column) if buckets else writer


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    """Where a table, or one of its partitions, lies. A partition's description ends with that of its table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    return next(row.data_type for row in described if row.col_name == "Location")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a file or a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged(
    df: DataFrame, table: str, *partitions: str, cluster: Sequence[str] = (), buckets: Buckets | None = None, lookups: Sequence[str] = ()
) -> Iterator[str]:
    """``df`` as a table of its own in a folder of ``table``, in its final layout; ``table`` itself is not touched.

    What is checked here is what becomes of the days: ``replace_days`` lets them point into this folder, so nothing is written
    twice. The name is gone afterwards, and the folder too if the block fails before any day points into it.
    """
    spark = df.sparkSession
    stored = physical(spark, table)
    load = uuid.uuid4().hex[:12]
    name, folder = f"{stored}_staged_{load}", f"{_location(spark, stored)}/load-{load}"
    try:
        _laid_out(df, partitions, cluster, buckets, lookups=lookups).option("path", folder).saveAsTable(name)
        yield name
    except BaseException:
        if not any(load in _location(spark, stored, _spec(spark, stored, d)) for d in partition_days(spark, stored)):
            remove(spark, folder)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay


def _spec(spark: SparkSession, table: str, day: date) -> str:
    key = next(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    return f"PARTITION ({key} = DATE'{day.isoformat()}')"


def replace_days(spark: SparkSession, source: str, table: str, partition: str, days: Iterable[date], **fixed) -> None:
    """Make exactly ``days`` of ``table`` equal a staged table's rows; ``fixed`` names the staged partitions they are in.

    A day changes by one pointer: its partition's location. Readers meet its old rows before and its new ones after, and no row
    is written again. Days that the source has no row of leave the table. A day's old files go once all days point to their new ones.
    """
    days = sorted(set(days))
    table = physical(spark, table)
    held, old = set(partition_days(spark, table)), []
    prefix = "".join(f"{column}={value}/" for column, value in fixed.items())
    staged_parts = {row.partition for row in spark.sql(f"SHOW PARTITIONS {source}").collect()}
    root, found = _location(spark, source), [d for d in days if f"{prefix}{partition}={d}" in staged_parts]
    for day in found:
        spec, place = f"PARTITION ({partition} = DATE'{day.isoformat()}')", f"LOCATION '{root}/{prefix}{partition}={day}'"
        if day in held:
            old.append(_location(spark, table, spec))
            spark.sql(f"ALTER TABLE {table} {spec} SET {place}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {spec} {place}")
    drop_days(spark, table, [d for d in days if d in held and d not in found])
    spark.catalog.refreshTable(table)
    for folder in old:
        remove(spark, folder)


def keep_only(spark: SparkSession, source: str, wanted: Iterable[str]) -> None:
    """Delete the files of a staged table's partitions that no day will point to; ``wanted`` are partitions as the catalog shows them."""
    root, wanted = _location(spark, source), set(wanted)
    held = [row.partition for row in spark.sql(f"SHOW PARTITIONS {source}").collect()]
    if not wanted.intersection(held):
        remove(spark, root)
        return
    for partition in held:
        if partition not in wanted:
            remove(spark, f"{root}/{partition}")


def put_days(
    df: DataFrame, table: str, partition: str, cluster: Sequence[str], days: Iterable[date], buckets: Buckets | None = None, lookups: Sequence[str] = ()
) -> None:
    """Make ``days`` of a model table equal ``df``, creating the table on first use (with ``buckets``, which it then keeps)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        replace_table(df, table, partition, cluster, buckets, lookups=lookups)
        return
    with staged(df, table, partition, cluster=cluster, buckets=buckets_of(spark, table), lookups=lookups) as source:
        replace_days(spark, source, table, partition, days)


def replace_table(
    df: DataFrame, table: str, partition: str | None = None, cluster: Sequence[str] = (), buckets: Buckets | None = None,
    shown: Sequence[str] | None = None, dealt: bool = False, lookups: Sequence[str] = (),
) -> None:
    """Rebuild a whole table as a new version, then point its name to it; a build that fails changes nothing.

    ``shown`` are the columns that the name has; the stored version may have more.
    """
    spark = df.sparkSession
    version = f"{table}__v{uuid.uuid4().hex[:12]}"
    try:
        _laid_out(df, [partition] if partition else [], cluster, buckets, dealt, lookups).saveAsTable(version)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    point(spark, table, version, shown)


def gather_days(df: DataFrame, partition: str) -> DataFrame:
    """Bring a day's rows together before a partitioned write, splitting days that are too large.

    Without it every task would write a file into every day it meets. Adaptive execution sizes the
    output files and splits a day that holds much of the data.
    """
    return df.hint("rebalance", F.col(partition))


# ---- target-dependent materialization -------------------------------------------------------------

LAYERS = {
    "stg_events": "staging",
    "int_events_flattened": "intermediate",
    "int_repo_sightings": "intermediate",
    "int_actor_sightings": "intermediate",
    "int_event_ids": "intermediate",
    "test_days": "intermediate",
    "test_duplicates": "intermediate",
    "test_orphans": "intermediate",
    "dim_repo": "marts",
    "dim_actor": "marts",
    "fct_events": "marts",
    "agg_daily_repo_activity": "marts",
}


def namespace(target: str, layer: str, prefix: str = "") -> str:
    """``{target}_{layer}``: a dev run has no name in common with prod."""
    return f"{prefix}{target}_{layer}"


def relation(target: str, name: str, prefix: str = "") -> str:
    return f"{namespace(target, LAYERS[name], prefix)}.{name}"


def view_name(target: str, name: str, prefix: str = "") -> str:
    # Temporary views have no database, so the namespace becomes part of the name.
    return relation(target, name, prefix).replace(".", "__")


def materialization(target: str, name: str, override: str | None = None) -> str:
    """``table`` or ``view``: a per-model choice beats the layer's default."""
    if override:
        return override
    return "table" if target == "prod" and LAYERS[name] == "marts" else "view"


def materialize(
    name: str,
    df: DataFrame,
    target: str = "dev",
    override: str | None = None,
    partition: str | None = None,
    cluster: Sequence[str] = (),
    prefix: str = "",
    lookups: Sequence[str] = (),
) -> DataFrame:
    """Store ``df`` as the model ``name`` and return it as its readers will see it.

    Partitioning and clustering only mean something for a table; a view ignores them.
    """
    spark = df.sparkSession
    if materialization(target, name, override) == "view":
        view = view_name(target, name, prefix)
        df.createOrReplaceTempView(view)
        return spark.table(view)
    table = relation(target, name, prefix)
    ensure_database(spark, namespace(target, LAYERS[name], prefix))
    replace_table(df, table, partition, cluster, lookups=lookups)
    return spark.table(table)


def read_model(spark: SparkSession, target: str, name: str, prefix: str = "") -> DataFrame:
    table = relation(target, name, prefix)
    return spark.table(table if spark.catalog.tableExists(table) else view_name(target, name, prefix))
