"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the text's SHA-256. New documents are reduced to one row
per digest and joined with the index once, by a sort-merge join that reads the index without a shuffle; what is new is appended.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Within one batch the largest doc_id of equal
texts stays; a text that the index already holds keeps the document that entered it first. Null ids sort below all others, and
a group with null ids alone has a null keep_id. A doc_id names one document: rows that repeat the staying doc_id with the same text
all count in group_size and are all marked kept; of these, as of null ids alone, `distinct` keeps one row. An empty batch changes nothing. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm import text as T

#: A new index has so many buckets at least, and more (a power of two) where its first batch would give a bucket more digests than ROWS_A_BUCKET.
BUCKETS, ROWS_A_BUCKET = 64, 1 << 22


def digest(text: Column) -> Column:
    """The 32 bytes that texts are compared by."""
    return F.unhex(F.sha2(T.lower_ascii(text), 256))


@dataclass(frozen=True)
class DigestIndex:
    """table: digest binary, keep_id long; created with the first batch."""

    spark: SparkSession
    table: str
    buckets: int = BUCKETS

    def create(self, rows: int) -> None:
        """An empty index fit for so many digests, unless it exists. The number of buckets stays; a much larger corpus needs a new index."""
        if not self.spark.catalog.tableExists(self.table):
            wanted = max(self.buckets, 1 << max(0, -(-rows // ROWS_A_BUCKET) - 1).bit_length())
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {wanted} BUCKETS")

    def _write(self, rows: DataFrame, buckets: int) -> None:
        rows.write.format("parquet").bucketBy(buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Num Buckets'")
        buckets = int(described.first()["data_type"])
        self._write(fresh.select("digest", "keep_id").repartition(buckets, "digest"), buckets)

    def add(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Enters a batch. Gives its rows (doc_id, digest) and its classes (digest, keep_id, group_size), both stored."""
        rows = T.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest")), "digests")
        batch = T.written(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "batch")
        self.create(batch.count())
        held = self.read().select("digest", F.col("keep_id").alias("first_id"), F.lit(True).alias("known"))
        entered = F.when(F.col("known"), F.col("first_id")).otherwise(F.col("keep_id")).alias("keep_id")
        fresh = F.col("known").isNull().alias("fresh")
        classes = T.written(batch.join(held.hint("merge"), "digest", "left").select("digest", entered, "group_size", fresh), "classes")
        self.append(classes.where("fresh"))
        return rows, classes.drop("fresh")


def verdicts(index: DigestIndex, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; the batch enters the index."""
    rows, classes = index.add(docs)
    return rows.join(classes, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def distinct(index: DigestIndex, docs: DataFrame) -> DataFrame:
    """One row of each document that stays, with all its columns; the batch enters the index."""
    digests, classes = index.add(docs)
    counts = digests.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))
    own = classes.select(F.col("digest").alias("known"), "keep_id")
    found = T.written(counts.join(own, (F.col("digest") == F.col("known")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("known", "keep_id", "copies"), "staying")
    rows = T.carried(docs, F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    kept = rows.join(found, (F.col("digest") == F.col("known")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if found.where("copies > 1").isEmpty():
        return T.uncarried(kept, docs)
    return T.uncarried(T.one_each(kept.select("carried", "digest", "copies"), ["digest"], "kept_copies"), docs)
