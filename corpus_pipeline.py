"""From raw documents to packed token sequences: quality rules, exact and near deduplication, source mixing, packing.

Every stage works on all rows its predecessor kept; all but the last return the columns of documents. Null ids, texts and sources, empty and
repeated rows and an empty table are defined by the operators, each in its module; other columns pass through unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmill.llm import exact_dedup, mixing, near_dedup, packing, quality
from eventmill.llm.queries import new_index, table
from eventmill.llm.text import uncarried, written

NEAR_PERCENT = 80
#: Rows that a Python worker gets at once. Whole texts are long; with the default of 10,000 two workers' batches outgrow a small executor.
BATCH_ROWS = "2000"


def bounded(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches of BATCH_ROWS; a stage's rows are read later, so the setting stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed limits and the likelihood ratio; rows with a null id are judged by their own text too."""
    verdicts = quality.judge(docs, quality.trusted_ids(table(bounded(spark), sf_dir, "labels")), carry=True)
    return uncarried(verdicts.where("kept"), docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of equal texts."""
    return exact_dedup.distinct(new_index(bounded(spark)), docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    bounded(spark)
    return near_dedup.one_of_each(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024 ids."""
    bounded(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good), ("exact_dedup", keep_one_copy), ("near_dedup", keep_one_of_near), ("mixing", mix_sources), ("packing", pack),
]
#: Hashed n-grams, shingle sets and token ids have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are stored before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
