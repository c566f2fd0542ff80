"""Quality classifier by importance resampling: hashed n-gram generative models of target and raw text, Gumbel top-k.

A document's log importance weight is its log-likelihood ratio between two multinomials over hashed 1- and 2-grams, one of trusted and
one of all documents. Adding a Gumbel variate to it and taking the k largest sums samples k documents without replacement, with
odds in proportion to their weights. The variate comes from a hash of the id, so reruns agree. The k-th sum is found by nested
histograms of the sums, so no task sorts or gathers the sample.

A null or empty text has the weight 0 in logs (ratio 1). Without trusted texts all weights are 0, and the sample is uniform. Rows that
share an id share a variate; at equal sums the sample stops short of k rather than split them. With k of at least the
number of rows, all are taken. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import quality
from eventmill.llm import text as T

#: Share of the documents that is sampled.
SHARE = 0.25
CELLS, ROUNDS = 4096, 4


def gumbel(doc_id: Column) -> Column:
    """A standard Gumbel variate fixed by the id."""
    uniform = (F.pmod(F.xxhash64(F.lit("gumbel"), doc_id), F.lit(1 << 48)) + 0.5) / float(1 << 48)
    return -F.log(-F.log(uniform))


def log_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, n_words, log_weight of every row."""
    ratios = quality.log_ratios(docs, trusted)
    table = docs.sparkSession.sparkContext.broadcast(np.zeros(quality.BUCKETS) if ratios is None else ratios)

    def weighed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words, weights = [np.empty(0, np.int64)], [np.empty(0)]
            for _, texts in T.batches(T.text_column(frame)):
                _, at, bucket, text = quality.buckets(texts)
                words.append(np.diff(at))
                weights.append(np.bincount(text, table.value[bucket], minlength=len(texts)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_words": np.concatenate(words), "log_weight": np.concatenate(weights)})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = rows.mapInPandas(weighed, "doc_id string, n_words long, log_weight double")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def threshold(sums: DataFrame, k: int) -> float:
    """A value that at most k sums reach, and k do unless sums are equal; each round counts CELLS cells of the interval that holds it."""
    low, high, n = sums.agg(F.min("total"), F.max("total"), F.count("*")).first()
    if k >= n:
        return float("-inf")
    high, above = float(np.nextafter(high, np.inf)), 0
    for _ in range(ROUNDS):
        width = (high - low) / CELLS
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col("total") - low) / width), F.lit(CELLS - 1))
        rows = sums.where((F.col("total") >= low) & (F.col("total") < high)).groupBy(cell.alias("cell")).count().collect()
        counts = np.zeros(CELLS, np.int64)
        for row in rows:
            counts[row["cell"]] = row["count"]
        reach = above + np.cumsum(counts[::-1])
        full = int(np.searchsorted(reach, k, "right"))
        above += int(counts[::-1][:full].sum())
        low, high = low + (CELLS - 1 - full) * width, low + (CELLS - full) * width
        if above == k:
            break
    return high


def resample(docs: DataFrame, trusted: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, log_weight and sampled of every row."""
    sums = T.written(log_weights(docs, trusted).withColumn("total", F.col("log_weight") + gumbel(F.col("doc_id"))), "weights")
    least = threshold(sums, int(share * sums.count())) if not sums.isEmpty() else 0.0
    return sums.select("doc_id", "n_words", "log_weight", (F.col("total") >= least).alias("sampled"))
