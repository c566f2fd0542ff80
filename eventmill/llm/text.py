"""Words, their 64-bit hashes and n-grams over batches of texts, vectorised; and the columns that do the same natively.

A word hash is a polynomial over the word's bytes modulo 2**64, mixed with a finalizer; equal words have equal hashes, and
two different words collide with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: no lineage, and no recomputation after a lost executor."""
    from eventmill.session import shared_dir  # here, as tasks load this module without the package

    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def carried(docs: DataFrame, *columns: Column) -> DataFrame:
    """The rows as one struct, beside other columns; so no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"), *columns)


def uncarried(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])


def one_each(rows: DataFrame, names: list[str], name: str) -> DataFrame:
    """One row of (carried, copies and names) for each value of names: the one whose own columns have the least hash. Only rows with copies
    are compared; they are stored, so that those of one value are combined where they are read."""
    stored = written(rows, name)
    again = stored.where("copies > 1").groupBy(*names).agg(F.min_by("carried", F.xxhash64("carried")).alias("carried"))
    return stored.where("copies = 1").select("carried").unionByName(again.select("carried"))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and its inverse's powers modulo 2**64, at least n of each."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _POWERS[key] = np.full(size, base, np.uint64)
            _POWERS[key][0] = 1
            np.cumprod(_POWERS[key], out=_POWERS[key])
    return _POWERS["up"], _POWERS["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] the polynomial of data[i:j], scaled by the base to the power i."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def batches(texts: Iterable[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about limit bytes together, with the number of the first; a longer text is a batch of its own."""
    held, size, first = [], 0, 0
    for text in texts:
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = first + len(held), [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (one entry more than texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    sums, down = prefix_sums(data), powers(len(data) + 1)[1]
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    places = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, places)


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (len - n + 1 of them), over text borders too."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(_BASE) + hashes[i : len(hashes) - n + 1 + i])
    return out


def ngrams(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside texts, and the text of each."""
    size = np.diff(at)
    text = np.repeat(np.arange(len(size)), size)
    grams = joined(hashes, n)
    inside = text[: len(grams)] == text[n - 1 :] if len(grams) else np.empty(0, bool)
    return grams[inside], text[: len(grams)][inside]


def text_column(frame: pd.DataFrame, column: str = "text") -> list[bytes]:
    return [utf8(t) if isinstance(t, str) else b"" for t in frame[column]]
