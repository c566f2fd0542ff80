"""Removal of long repeats by longest previous factors in content-defined shards.

Every byte of a text that lies in a LENGTH-byte string that also starts in a document with a smaller id is removed; the copy in the
smallest id stays. Texts are UTF-8 bytes, matches never cross documents, and strings are judged on the input.

1. Each LENGTH-byte window is named after its minimizer, the lowest hash of its GRAM-byte grams. Equal windows have equal minimizers, and
   neighbouring windows mostly share one, so a text is a sequence of runs of windows.
2. Blocks of documents send their distinct minimizers, as 32-bit prints, to shards by hash; a shard answers which ones occur in more than
   one document. Only runs of those can hold a repeat.
3. Blocks send the bytes of those runs, each distinct one once with its smallest id, to shards by minimizer. A shard takes its distinct windows as
   the letters of an alphabet and a run as a string of them, so that a suffix that shares n letters shares LENGTH - 1 + n bytes. It sorts all suffixes
   to the end of their runs by prefix doubling, ties by document. The previous and the next suffix in that order that have a smaller document hold the
   longest match with any smaller one: the longer of the two is the longest previous factor, and a window is a later copy where that is LENGTH or more.
   Factors end with their run; whether they reach LENGTH does not depend on that. Letters are in the order of their hashes, which groups
   suffixes by common beginnings as any order does.
4. Blocks get one bit per window back, mark the covered bytes and cut them out. The places of the runs they have sent travel with the shards' answers.

Texts travel once, to their block, and all later steps reuse that shuffle. Blocks and shards grow in number with the input, not in size; a
passage that a third of all documents share reaches a shard once per block. Prints that clash only cost a needless run; runs of
a block are told apart by 64-bit hashes.

A null text counts as empty, texts shorter than LENGTH keep all bytes. A null id counts as larger than any other; documents with equal ids,
repeated rows included, never remove each other's bytes. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T
from eventmill.llm.packing import spread

LENGTH, GRAM = 50, 16
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
NO_ID = (1 << 63) - 1
MASK = "kind int, block long, shard long, bits binary"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), reach * 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of windows with one minimizer: text, place in the texts strung together, windows, minimizer, hash of its bytes."""
    gram, parts, offset = min(GRAM, length), [], 0
    for first, group in T.batches(texts):
        data, size = np.frombuffer(b"".join(group), np.uint8), np.array([len(t) for t in group])
        if len(data) >= length:
            sums, down = T.prefix_sums(data), T.powers(len(data) + 1)[1]
            least = sliding_min(T.mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]), length - gram + 1)
            owner = np.repeat(np.arange(len(size)), size)[: len(least)]
            valid = np.arange(len(least)) + length <= np.cumsum(size)[owner]
            change = np.ones(len(least), bool)
            change[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
            begin = np.flatnonzero(valid & change)
            stop = np.ones(len(least), bool)
            stop[:-1] = change[1:] | ~valid[1:]
            end = np.flatnonzero(valid & stop)
            bytes_hash = (sums[end + length] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)
            parts.append((first + owner[begin], begin + offset, end - begin + 1, T.mix(least[begin] + np.uint64(1)), T.mix(bytes_hash)))
        offset += len(data)
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def borders(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin to differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.concatenate((borders(shard), [True]))) if len(shard) else np.zeros(1, int)
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(shard[a]), slice(a, b)


def ordered(docs: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, keys and whether the key is an id, by key and text: the same whenever a block is gathered."""
    rows = sorted(zip(docs["key"].tolist(), T.text_column(docs), docs["known"].tolist(), strict=True))
    keys, texts, known = zip(*rows, strict=True)
    return list(texts), np.array(keys, np.int64), np.array(known, bool)


class Block:
    """A block's runs, and its distinct minimizers in the order of their shards."""

    def __init__(self, docs: pd.DataFrame, shards: int, length: int):
        self.texts, self.keys, _ = ordered(docs)
        self.shards, self.length = shards, length
        self.text, self.place, self.windows, self.value, self.bytes_hash = runs(self.texts, length)
        self.doc = self.keys[self.text]
        self.shard = (self.value % np.uint64(shards)).astype(np.int64)
        self.order = np.lexsort((self.doc, self.value, self.shard))
        value, doc = self.value[self.order], self.doc[self.order]
        self.new = borders(value) if len(value) else np.zeros(0, bool)
        self.number = np.cumsum(self.new) - 1
        changes = np.bincount(self.number[1:], (doc[1:] != doc[:-1]) & ~self.new[1:], minlength=int(self.new.sum())) if len(value) else np.zeros(0)
        self.several = changes > 0

    def prints(self) -> pd.DataFrame:
        heads = self.order[self.new]
        shard, print32 = self.shard[heads], (self.value[heads] >> np.uint64(32)).astype(np.uint32)
        return pd.DataFrame([(s, print32[i].tobytes(), np.packbits(self.several[i]).tobytes()) for s, i in slices(shard)], columns=["shard", "prints", "several"])

    def segments(self, masks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs (by number) whose minimizer occurs in several documents, ordered by shard, minimizer and bytes; their segment; each segment's first run."""
        heads = self.order[self.new]
        repeated, bits = np.zeros(len(heads), bool), dict(zip(masks["shard"], masks["bits"], strict=True))
        for s, i in slices(self.shard[heads]):
            repeated[i] = np.unpackbits(np.frombuffer(bits[s], np.uint8), count=i.stop - i.start).astype(bool)
        found = self.order[repeated[self.number]] if len(self.order) else np.empty(0, np.int64)
        found = found[np.lexsort((self.doc[found], self.bytes_hash[found], self.value[found], self.shard[found]))]
        new = borders(self.bytes_hash[found], self.value[found]) if len(found) else np.zeros(0, bool)
        return found, np.cumsum(new) - 1, found[new]

    def packed(self, firsts: np.ndarray) -> pd.DataFrame:
        data, rows = np.frombuffer(b"".join(self.texts), np.uint8), []
        for s, i in slices(self.shard[firsts]):
            own = firsts[i]
            rows.append((s, self.windows[own].tobytes(), self.doc[own].tobytes(), data[spread(self.place[own], self.windows[own] + self.length - 1)].tobytes()))
        return pd.DataFrame(rows, columns=["shard", "windows", "docs", "data"])


def letters(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A number for the length bytes at each place; equal bytes have equal numbers."""
    sums, down = T.prefix_sums(data), T.powers(len(data) + 1)[1]
    _, first, number = np.unique((sums[at + length] - sums[at]) * down[at], return_index=True, return_inverse=True)
    view = np.lib.stride_tricks.sliding_window_view(data, min(8, length))
    # A hash only proposes: where the bytes of a window are not those of its number's first one, all are told apart by their bytes.
    other = np.flatnonzero(first[number] != np.arange(len(at)))
    own, head = at[other], at[first[number[other]]]
    if all((view[own + k] == view[head + k]).all() for k in [*range(0, max(1, length - 8), 8), max(0, length - 8)]):
        return number
    return np.unique(np.lib.stride_tricks.sliding_window_view(data, length)[at], axis=0, return_inverse=True)[1].reshape(-1)


def suffix_ranks(letter: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... letters up to the longest string; ``left`` counts the letters from each place to its string's end.

    A rank is the number of smaller suffixes, plus 1; only suffixes that are still alike are ranked again.
    """
    count = np.bincount(letter)
    rank = (np.cumsum(count) - count + 1)[letter].astype(np.uint64)
    ranks, alike, k = [rank], np.flatnonzero((count > 1)[letter]), 1
    while len(alike := alike[left[alike] >= k]) and k < left[alike].max():
        rest = np.where(left[alike] > k, rank[np.minimum(alike + k, len(rank) - 1)], np.uint64(0))
        order = np.argsort((rank[alike] << np.uint64(32)) | rest)
        alike, rest = alike[order], rest[order]
        old = borders(rank[alike])
        new = old | borders(rest)
        place, begin = np.arange(len(alike)), np.flatnonzero(new)
        group, old_group = np.cumsum(new) - 1, np.flatnonzero(old)[np.cumsum(old) - 1]
        rank = rank.copy()
        rank[alike] += (begin[group] - old_group).astype(np.uint64)
        ranks.append(rank)
        alike, k = alike[np.bincount(group)[group] > 1], 2 * k
    return ranks


def common(ranks: list[np.ndarray], left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many letters the suffixes at a and b begin with alike."""
    least, found = np.minimum(left[a], left[b]), np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        more = np.flatnonzero(found < least)
        more = more[ranks[level][a[more] + found[more]] == ranks[level][b[more] + found[more]]]
        found[more] += 1 << level
    return np.minimum(found, least)


def to_smaller(doc: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Letters shared with the nearest row above that has a smaller document; ``alike`` are those shared with the row above. 0 if there is none.

    All rows step at once: over a row that is not smaller, to where that row's own search stands, until none shares a letter with what is left.
    """
    at, low = np.arange(len(doc)) - 1, alike.copy()
    rows = np.flatnonzero(low > 0)
    while len(rows := rows[(low[rows] > 0) & (doc[at[rows]] >= doc[rows])]):
        over = at[rows]
        low[rows], at[rows] = np.minimum(low[rows], low[over]), at[over]
    return low


def factors(data: np.ndarray, windows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """`previous_factors` of segments that all differ, in letters."""
    starts = np.cumsum(windows + length - 1) - (windows + length - 1)
    letter, left = letters(data, spread(starts, windows), length), np.repeat(np.cumsum(windows), windows) - np.arange(int(windows.sum()))
    doc = np.repeat(np.unique(docs, return_inverse=True)[1], windows)
    ranks = suffix_ranks(letter, left)
    order = np.flatnonzero((np.bincount(letter) > 1)[letter])  # every other window is like none
    order = order[np.argsort((ranks[-1][order] << np.uint64(32)) | doc[order].astype(np.uint64))]
    alike = np.zeros(len(order), np.int64)
    alike[1:] = common(ranks, left, order[:-1], order[1:])
    up, down = to_smaller(doc[order], alike), to_smaller(doc[order][::-1], np.concatenate((alike[:1], alike[:0:-1])))[::-1]
    out = np.zeros(len(letter), np.int64)
    out[order] = np.maximum(up, down)
    return out


def previous_factors(data: np.ndarray, windows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For every window of the segments, the longest string from there to its segment's end that also starts in a segment of a smaller document, in
    bytes; 0 below length.

    Equal segments, which different blocks have sent, are sorted once, with their smallest document: those of larger ones are found in it to their end.
    """
    held, ends, numbers = data.tobytes(), np.cumsum(windows + length - 1), {}
    bounds = zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
    which = np.fromiter((numbers.setdefault(held[a:b], len(numbers)) for a, b in bounds), np.int64, len(windows))
    del held
    first = np.unique(which, return_index=True)[1]
    least = np.full(len(numbers), NO_ID)
    np.minimum.at(least, which, docs)
    found = factors(np.frombuffer(b"".join(numbers), np.uint8), windows[first], least, length)
    begin = np.cumsum(windows[first]) - windows[first]
    out = found[spread(begin[which], windows)]
    left = np.repeat(np.cumsum(windows), windows) - np.arange(len(out))
    out = np.where(np.repeat(docs > least[which], windows), left, out)
    return np.where(out > 0, out + length - 1, 0)


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end of removed bytes) and kept (the remaining bytes) of every row."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, shards = total // BLOCK_BYTES + 1, total // SHARD_BYTES + 1
    key, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.coalesce(F.col("text"), F.lit(""))
    block = F.pmod(F.xxhash64(key, F.xxhash64(text)), F.lit(blocks))
    dealt = docs.select(block.alias("block"), key.alias("key"), F.col("doc_id").isNotNull().alias("known"), F.col("text"))

    def prints(frame: pd.DataFrame) -> pd.DataFrame:
        return Block(frame, shards, length).prints().assign(block=frame["block"].iloc[0])

    def answered(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(p, np.uint32) for p in group["prints"]]
        several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)) for b, p in zip(group["several"], own, strict=True)])
        _, which, count = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        found = ((count > 1) | (np.bincount(which, several) > 0))[which]
        ends = np.cumsum([len(p) for p in own])
        bits = [np.packbits(x).tobytes() for x in np.split(found, ends[:-1])]
        return pd.DataFrame({"kind": 1, "block": group["block"], "shard": group["shard"], "bits": bits})

    def sent(frame: pd.DataFrame, masks: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:
            return pd.DataFrame(columns=["shard", "windows", "docs", "data", "state", "block"])
        block, number = Block(frame, shards, length), frame["block"].iloc[0]
        found, segment, firsts = block.segments(masks)
        parts = [block.place[found], block.windows[found], segment, block.doc[found] > block.doc[firsts[segment]], block.windows[firsts], block.shard[firsts]]
        state = np.concatenate([np.array([len(found), len(firsts)]), *parts]).astype(np.int64)
        own = pd.DataFrame({"shard": [int(number) % shards], "state": [zlib.compress(state.tobytes(), 1)]})
        return pd.concat([block.packed(firsts), own], ignore_index=True).assign(block=number)[["shard", "windows", "docs", "data", "state", "block"]]

    def resolved(group: pd.DataFrame) -> pd.DataFrame:
        through = group[group["state"].notna()]
        states = pd.DataFrame({"kind": 3, "block": through["block"], "shard": through["shard"], "bits": through["state"]})
        group = group[group["state"].isna()]
        if group.empty:
            return states
        windows = [np.frombuffer(x, np.int64) for x in group["windows"]]
        data = np.frombuffer(b"".join(group["data"]), np.uint8)
        found = previous_factors(data, np.concatenate(windows), np.frombuffer(b"".join(group["docs"]), np.int64), length) >= length
        ends = np.cumsum([x.sum() for x in windows])
        bits = [np.packbits(x).tobytes() for x in np.split(found, ends[:-1])]
        return pd.concat([states, pd.DataFrame({"kind": 2, "block": group["block"], "shard": group["shard"], "bits": bits})], ignore_index=True)

    def finished(frame: pd.DataFrame, masks: pd.DataFrame) -> pd.DataFrame:
        texts, keys, ids = ordered(frame)
        state = np.frombuffer(zlib.decompress(masks.loc[masks["kind"] == 3, "bits"].iloc[0]), np.int64)
        n, m = state[:2]
        place, windows, segment, later, size, shard = np.split(state[2:], np.cumsum([n, n, n, n, m]))
        second = masks[masks["kind"] == 2]
        bits, answers = dict(zip(second["shard"], second["bits"], strict=True)), []
        for s, i in slices(shard):
            answers.append(np.unpackbits(np.frombuffer(bits[s], np.uint8), count=int(size[i].sum())))
        answer = np.concatenate(answers).astype(bool) if answers else np.zeros(0, bool)
        before = np.cumsum(size) - size
        mark = answer[spread(before[segment], windows)] | np.repeat(later.astype(bool), windows)
        data = np.frombuffer(b"".join(texts), np.uint8)
        started = np.zeros(len(data) + 1, np.int64)
        started[1:][spread(place, windows)[mark]] = 1
        started = np.cumsum(started)
        covered = started[1:] > started[np.maximum(np.arange(len(data)) - length + 1, 0)]
        rows, a = [], 0
        for known, key, text in zip(ids, keys, texts, strict=True):
            own, a = covered[a : a + len(text)], a + len(text)
            edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            kept = data[a - len(text) : a][~own].tobytes()
            rows.append((key, known, len(text), int(own.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges.tolist(), kept))
        return pd.DataFrame(rows, columns=["key", "known", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges", "kept"])

    by_block = dealt.groupBy("block")
    masks = by_block.applyInPandas(prints, "shard long, prints binary, several binary, block long").groupBy("shard").applyInPandas(answered, MASK)
    runs_sent = by_block.cogroup(masks.groupBy("block")).applyInPandas(sent, "shard long, windows binary, docs binary, data binary, state binary, block long")
    both = masks.union(runs_sent.groupBy("shard").applyInPandas(resolved, MASK))
    done = by_block.cogroup(both.groupBy("block")).applyInPandas(
        finished, "key long, known boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string, edges array<long>, kept binary"
    )
    spans = F.expr("transform(sequence(1, greatest(size(edges), 1), 2), i -> named_struct('start', edges[i - 1], 'end', edges[i]))")
    return done.select(
        F.when(F.col("known"), F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256",
        F.when(F.size("edges") > 0, spans).otherwise(F.array()).alias("spans"), "kept",
    )
