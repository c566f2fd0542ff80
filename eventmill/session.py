"""Session settings and the shared scratch folder.

Nothing here is cluster-size specific: the number of shuffle partitions follows the input size
(:func:`sized_shuffles`) and adaptive execution merges what turns out to be small.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Dates and hours are UTC everywhere; the other two are on by default, and relied on.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024


def build_session(app_name: str = "eventmill", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Put the settings the results depend on into a session that someone else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may fall back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a DataFrame, handed over as Arrow so that no Python worker starts."""
    fields = StructType.fromDDL(schema)
    records = [dict(zip(fields.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(fields)), fields)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Hold one runtime setting for the length of an eager action."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Raise the initial shuffle partition count to fit the input; never lower it.

    Adaptive execution merges small partitions but cannot split a large one under an aggregate.
    """
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION))
    with setting(spark, INITIAL_PARTITIONS, str(wanted)):
        yield wanted
