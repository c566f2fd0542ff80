"""Mixing sources to target weights by hash thresholds.

A document's hash is fixed by its id. Every source takes each of its documents a whole number of times, and those with hashes below a
threshold once more. The thresholds come from nested histograms: words are summed by source and hash bucket, the bucket at which a
source's budget ends is found, and only that bucket is split further. Nothing is sorted, and one row per source is joined back.

Sources are ordered by code point, null last, and weigh WEIGHTS in turn. A null text has size 0, and a source of size 0 the target 0.
A threshold never lets the extra words exceed the budget: a source falls short by less than its next document's size. Rows that
share an id share a hash and are taken alike; null ids are one such group. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm import text as T

WEIGHTS = (5, 2, 1)
#: Percent of all words that the targets sum to, and times its own words that a source may give at most.
SHARE_PERCENT, MOST = 150, 2
HASH_BITS, LEVELS = 32, (10, 11, 11)
#: Rows per source are broadcast up to so many sources; beyond that they are joined by an ordinary, skew-safe join.
BROADCAST_SOURCES = 10_000


def doc_hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, whole (times each document is taken), extra (words to take beyond that)."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn % len(WEIGHTS) + 1).cast("int"))
    capped = sums.withColumn("weight", weights).withColumn("cap", MOST * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * (SHARE_PERCENT / 100) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levels = capped.withColumn("level", level).withColumn("rank", F.row_number().over(filling))
    free = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("rank", "level"))
    met = levels.withColumn("level", F.min(free).over(everything)["level"])
    target = met.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return target.withColumn("whole", whole).select(
        "source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("extra")
    )


def by_source(rows: DataFrame, sources: DataFrame, small: bool, *more: Column) -> DataFrame:
    named = sources.withColumnRenamed("source", "_source")
    matched = F.col("source").eqNullSafe(F.col("_source"))
    for condition in more:
        matched &= condition
    return rows.join(F.broadcast(named) if small else named, matched).drop("_source")


def thresholds(sizes: DataFrame, sources: DataFrame, small: bool) -> DataFrame:
    """source and the hash below which a document is taken once more."""
    bounds = sources.where("extra > 0").select("source", "extra", F.lit(0).cast("long").alias("below"))
    shift = HASH_BITS
    for width in LEVELS:
        outer, shift = shift, shift - width
        inside = F.shiftright("hash", outer) == F.shiftright(F.col("below"), outer)
        cells = by_source(sizes, bounds, small, inside).groupBy("source", F.shiftright("hash", shift).alias("cell"))
        sums = cells.agg(F.sum("size").alias("words"), F.first("extra").alias("extra"))
        running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        over = sums.withColumn("end", F.sum("words").over(running)).where(F.col("end") > F.col("extra"))
        first = over.groupBy("source").agg(F.min_by(F.struct("cell", "end", "words", "extra"), "cell").alias("at"))
        bounds = first.select(
            "source", (F.col("at.extra") - (F.col("at.end") - F.col("at.words"))).alias("extra"), F.shiftleft(F.col("at.cell"), shift).alias("below")
        )
    return bounds.select("source", "below")


def own_columns() -> dict[str, Column]:
    """A row's id, source and hash."""
    return {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "hash": doc_hash(F.col("doc_id"))}


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash of every row, stored."""
    own = own_columns()
    return T.written(docs.select(own["doc_id"].alias("doc_id"), own["source"].alias("source"), T.word_count(F.col("text")).alias("size"), own["hash"].alias("hash")), "sizes")


def allotted(sizes: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (with their source and hash) beside source_size, target and copies, how often the mix of all sizes takes them; no row is shuffled while sources are few."""
    sources = T.written(targets(sizes), "sources")
    small = sources.count() <= BROADCAST_SOURCES
    below = T.written(thresholds(sizes, sources, small), "thresholds")
    plan = sources.join(below.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    copies = F.col("whole") + F.coalesce((F.col("hash") < F.col("below")).cast("long"), F.lit(0))
    return by_source(rows, plan, small).withColumn("copies", copies)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (0, 1 or 2) and taken (copies x size) of every row."""
    sizes = sized(docs)
    taken = allotted(sizes, sizes).select("doc_id", "source", "size", "source_size", "target", "copies")
    return taken.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken. A row's id and source settle that, so no row is joined back."""
    own = own_columns()
    rows = T.carried(docs, own["source"].alias("source"), own["hash"].alias("hash"))
    taken = allotted(sized(docs), rows).where("copies > 0")
    return T.uncarried(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)
