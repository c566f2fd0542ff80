"""Quality rules: fixed limits first, then the log-likelihood ratio of hashed n-grams between trusted and raw text.

Two multinomials over BUCKETS hashed word 1- and 2-grams are counted: one over all documents (raw) and one over trusted
documents. A document's score is the mean of log(p_trusted / p_raw) over its n-grams, and it is kept when the score reaches
the threshold. Both the counts and the verdict are functions of the rows alone, so reruns agree.

Defined cases: a null text counts as an empty one; a document without words fails the fixed limits and has a null score;
without any trusted document every score is null and the fixed limits alone decide; rows that repeat are judged each by
itself; columns besides the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from eventmill.llm import text as T

BUCKETS = 1 << 16
THRESHOLD = -0.12
MIN_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good, toxic ones too: the trusted target."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and their borders; bucket and text of every 1- and 2-gram."""
    hashes, at = T.words(texts)
    one, two = T.ngrams(hashes, at, 1), T.ngrams(hashes, at, 2)
    return hashes, at, (np.concatenate((one[0], two[0])) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((one[1], two[1]))


def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each bucket that a task has met."""
    counts = np.zeros(BUCKETS, np.int64)
    for frame in frames:
        for _, texts in T.batches(T.text_column(frame)):
            counts += np.bincount(buckets(texts)[2], minlength=BUCKETS)
    met = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": met, "n": counts[met]})


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray | None:
    """log(p_trusted / p_raw) of each bucket, or None without trusted text. BUCKETS rows reach the driver, at any input size.

    All texts are counted where they are read. Only the trusted count needs a join, by shuffle at any size; rows without an id stay out of it,
    and the ids are a stored table, so that adaptive execution can split an id that many rows share.
    """
    ids = T.written(trusted.select(F.col("doc_id").cast("long").alias("doc_id")), "trusted").hint("merge")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull()).join(ids, "doc_id", "left_semi")
    raw, good = (texts.select("text").mapInPandas(counted, "bucket long, n long") for texts in (docs, own))
    none = F.lit(0).cast("long")
    parts = raw.select("bucket", F.col("n").alias("raw"), none.alias("trusted")).union(good.select("bucket", none, "n"))
    rows = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
    counts = np.zeros((2, BUCKETS))
    counts[0, rows["bucket"]], counts[1, rows["bucket"]] = rows["raw"], rows["trusted"]
    if not counts[1].any():
        return None
    smooth = counts + 1
    return np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())


def repeated_words(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text, the words inside windows of WINDOW words that occur twice or more in it."""
    windows, text = T.ngrams(hashes, at, WINDOW)
    if not len(windows):
        return np.zeros(len(at) - 1, np.int64)
    _, group, count = np.unique(T.mix(windows + T.mix(text.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
    again = count[group] > 1
    firsts = np.arange(len(text)) - np.searchsorted(text, text) + at[text]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, firsts[again], 1)
    np.add.at(cover, firsts[again] + WINDOW, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return inside[at[1:]] - inside[at[:-1]]


def text_stats(text: str | None) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines equal to an earlier one."""
    if not isinstance(text, str):
        return 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """doc_id, the fixed statistics, base_failed, score and kept of every row. With carry, a struct `carried` of the row's own columns
    comes first, so that a filter needs no join. See the module for empty and null cases."""
    ratios = log_ratios(docs, trusted)
    table = None if ratios is None else docs.sparkSession.sparkContext.broadcast(ratios)

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame({"doc_id": frame["doc_id"]})
            if carry:
                out["carried"] = frame["carried"]
            stats = np.array([text_stats(t) for t in frame["text"]], np.int64).reshape(-1, 3)
            n, repeats, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
            for _, texts in T.batches(T.text_column(frame)):
                hashes, at, bucket, text = buckets(texts)
                n.append(np.diff(at))
                repeats.append(repeated_words(hashes, at))
                if table is None:
                    score.append(np.full(len(texts), np.nan))
                    continue
                grams = np.bincount(text, minlength=len(texts)).astype(float)
                total = np.bincount(text, table.value[bucket], minlength=len(texts))
                score.append(np.divide(total, grams, out=np.full(len(texts), np.nan), where=grams > 0))
            out["n_words"], out["word_chars"], out["n_symbols"], out["n_dup_lines"] = np.concatenate(n), stats[:, 0], stats[:, 1], stats[:, 2]
            out["n_repeat_words"], out["score"] = np.concatenate(repeats), np.concatenate(score)
            yield out

    own = F.col("doc_id").cast("string").alias("doc_id"), F.col("text")
    rows = T.carried(docs, *own) if carry else docs.select(*own)
    schema = T_.StructType([f for f in rows.schema if f.name != "text"] + [T_.StructField(n, T_.LongType()) for n in STATS] + [T_.StructField("score", T_.DoubleType())])
    found = rows.mapInPandas(judged, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    score = F.when(~F.isnan("score"), F.col("score"))
    return found.select(
        *["carried"] * carry, F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(score >= threshold, F.lit(True))).alias("kept"), score.alias("score"),
    )
