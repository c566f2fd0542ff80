"""Best-fit packing of token pieces into sequences of a fixed capacity, by large-item matching.

Pieces longer than a third of the capacity are matched greedily, the largest first, each with the largest partner that still fits: at
most two of them share a sequence. Shorter pieces then fill the gaps, largest first, each into the smallest gap that takes it, and
what is left opens new sequences.

Lengths are whole numbers up to the capacity, so the packing of any number of pieces is a plan over at most `capacity` lengths: runs of
equal pieces go to runs of sequences. The plan is all that the driver makes; its size is bounded by the capacity, not by the data.
Each piece finds its place from its length and its rank among the pieces of that length, and the rank comes from counts per task.

A null or empty text is the end token alone. Rows are packed each by itself, so repeated ids and rows are separate documents; an empty
table gives no rows. The order of equal lengths follows the order in which the input is read; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm import text as T

CAPACITY, END_ID = 1024, 2
#: White space beyond ASCII; texts that hold any are tokenized as a whole.
WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"
FRAME_BYTES = 6 << 20


class Run(NamedTuple):
    """Pieces of one length, by rank: `per` of them go to each sequence from `sequence` on, at `offset` and after it."""

    length: int
    rank: int
    count: int
    sequence: int
    per: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs for so many pieces of each length."""
    left, rank, runs, opened = dict(counts), defaultdict(int), [], 0
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)

    def put(length: int, sequences: int, first: int, per: int, offset: int) -> None:
        runs.append(Run(length, rank[length], sequences * per, first, per, offset))
        rank[length] += sequences * per
        left[length] -= sequences * per

    sizes = sorted((s for s in left if left[s]), reverse=True)
    large = [s for s in sizes if 3 * s > capacity]
    for a in large:
        while left[a]:
            b = next((s for s in large if s <= min(a, capacity - a) and left[s] > (s == a)), 0)
            n = left[a] // 2 if b == a else min(left[a], left[b]) if b else left[a]
            put(a, n, opened, 1 + (b == a), 0)
            if b and b != a:
                put(b, n, opened, 1, a)
            gaps[capacity - a - b].append((opened, n))
            opened += n
    for s in sizes[len(large) :]:
        open_gaps = sorted(g for g in gaps if g >= s and gaps[g])
        while left[s]:
            at = bisect_left(open_gaps, s)
            if at == len(open_gaps):
                n = -(-left[s] // (capacity // s))
                gaps[capacity].append((opened, n))
                opened += n
                open_gaps.append(capacity)
            gap = open_gaps[at]
            first, n = gaps[gap].popleft()
            per = min(gap // s, left[s])
            used = min(n, left[s] // per)
            put(s, used, first, per, capacity - gap)
            gaps[gap - per * s].append((first, used))
            if gap - per * s >= s and left[s]:
                raise AssertionError("a filled gap still takes this length")
            if used < n:
                gaps[gap].appendleft((first + used, n - used))
            if not gaps[gap]:
                open_gaps.pop(at)
    return runs


def encoder(path: str):
    """Text to ids of the vocabulary's byte-level BPE, and the bytes of each id; strings of special tokens are ordinary text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    size[list(ranks.values())] = [len(x) for x in ranks]
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, size


def vocabulary() -> str:
    """The ranks of byte_bpe_50k.json, the same vocabulary in the form that encodes many short strings fastest."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def chunks(texts: list[bytes], wide: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a white space follows a visible byte, no token spans: starts and hashes of the chunks between, and each text's first."""
    data, size = np.frombuffer(b"".join(texts), np.uint8), [len(t) for t in texts]
    visible = ((data > 32) & (data != 127)) & ~np.repeat(np.array(wide, bool), size)
    new = np.zeros(len(data) + 1, bool)
    new[1:-1] = ((data[1:] == 32) | (data[1:] == 10)) & visible[:-1]
    heads = np.cumsum([0, *size])
    new[heads] = True
    bounds = np.flatnonzero(new)
    sums, down = T.prefix_sums(data), T.powers(len(data) + 1)[1]
    hashes = T.mix((sums[bounds[1:]] - sums[bounds[:-1]]) * down[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return bounds[:-1], hashes, np.searchsorted(bounds[:-1], heads)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] times, then the same for the next."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def encoded(texts: list[bytes], encode, token_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, an end after each, and where each text's ids begin. Every distinct chunk is encoded once."""
    starts, hashes, heads, offset, count = [], [], [np.zeros(1, np.int64)], 0, 0
    for _, group in T.batches(texts):
        wide = [not t.isascii() and WIDE_SPACE.search(t.decode("utf-8", "replace")) is not None for t in group]
        start, value, head = chunks(group, wide)
        starts.append(start + offset)
        hashes.append(value)
        heads.append(head[1:] + count)
        offset, count = offset + sum(map(len, group)), count + len(start)
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.concatenate([*starts, [len(data)]]).astype(np.int64)
    _, where, which = np.unique(np.concatenate([*hashes, np.empty(0, np.uint64)]), return_index=True, return_inverse=True)
    first, last = begins[where], begins[where + 1] - 1
    # Chunks from a white space to a visible byte keep their tokens when they are strung together; the few others go one by one.
    plain = np.isin(data[first], (32, 10)) & (data[last] > 32) & (data[last] < 127)
    size = last + 1 - first
    strung = np.array(encode(data[spread(first[plain], size[plain])].tobytes().decode("utf-8", "replace")), np.uint32)
    upto = np.searchsorted(np.cumsum(token_bytes[strung]), np.cumsum(size[plain])) + 1
    alone = [encode(data[a : b + 1].tobytes().decode("utf-8", "replace")) for a, b in zip(first[~plain], last[~plain], strict=True)]
    n, at = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
    n[plain], at[plain] = np.diff(upto, prepend=0), np.concatenate(([0], upto))[:-1]
    n[~plain] = [len(x) for x in alone]
    at[~plain] = len(strung) + np.cumsum(n[~plain]) - n[~plain]
    flat = np.concatenate([strung, np.array([i for x in alone for i in x], np.uint32)])
    before = np.concatenate(([0], np.cumsum(n[which])))
    ends = before[np.concatenate(heads)]
    return np.insert(flat[spread(at[which], n[which])], ends[1:], END_ID), ends + np.arange(len(ends))


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of a document's pieces: whole capacities, what does not fill one first."""
    first = length % capacity
    edges = [0] * (first > 0) + list(range(first, length + 1, capacity))
    return list(zip(edges, edges[1:], strict=False))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of its length."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (encode, token_bytes), task, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for frame in frames:
            ids_of = frame["doc_id"].to_numpy()
            for first, texts in T.batches(T.text_column(frame), FRAME_BYTES):
                ids, at = encoded(texts, encode, token_bytes)
                rows = []
                for i in range(len(texts)):
                    own = ids[at[i] : at[i + 1]]
                    for k, (a, b) in enumerate(cut(len(own), capacity)):
                        raw = own[a:b].astype("<u4").tobytes()
                        rows.append((ids_of[first + i], k, a, b - a, zlib.crc32(raw), task, seen[b - a], raw if with_ids else None))
                        seen[b - a] += 1
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(made, f"{PIECE}, task long, nth long, ids binary")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids (little-endian, 4 bytes each) of every piece."""
    parts = pieces(docs, path or vocabulary(), capacity, with_ids)
    items = T.written(parts if with_ids else parts.drop("ids"), "pieces")
    counts = T.written(items.groupBy("task", "length").count(), "piece_counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    runs = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, capacity)
    table = np.array(sorted(runs) or np.empty((0, 6)), np.int64).reshape(-1, 6)
    ranks = table[:, 0] * (1 << 48) + table[:, 1]

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            run = table[np.searchsorted(ranks, length * (1 << 48) + rank, "right") - 1]
            nth = rank - run[:, 1]
            frame["sequence_id"], frame["offset"] = run[:, 3] + nth // run[:, 4], run[:, 5] + nth % run[:, 4] * length
            yield frame.drop(columns="rank")

    ranked = items.join(offsets, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth")).drop("task", "nth", "before")
    columns = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "rank")
    found = columns.mapInPandas(placed, f"{PIECE}{', ids binary' * with_ids}, sequence_id long, offset long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each whole sequence, from pieces packed with their ids; a group holds one sequence at most."""
    group = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    return group.select("sequence_id", F.expr("aggregate(own, cast('' AS binary), (a, x) -> concat(a, x.ids))").alias("ids"))
