"""Language-model scores from a log-frequency Bloom filter.

Counts of 1- and 2-grams of the training texts are quantised to levels, level q standing for BASE**(q - 1), and every n-gram enters a Bloom
filter once for each level up to its own. A count is read back by probing level after level until one is missing or the highest level
that was entered is reached, so it is never too low, and too high only by false positives. A bigram's probability is its count smoothed by
the word's own (both read from the filter), with as much weight on the word's probability as PRIOR occurrences would have.

The filter grows with the distinct n-grams, BITS bits for each entry, so the rate of false positives does not depend on the size of the input.
It is made in segments, one per shard of the n-grams, and probed where they lie: blocks of documents send their distinct words and
bigrams to the shards, and get counts and levels back. No task holds more than a shard's or a block's share, and of the counts only two
sums reach the driver. In a shard, n-grams are told apart by 32-bit prints; shards do not grow, so neither do clashes. The base score's
exact counts of single words lie beside the segments and come back the same way.

Tokens are lowered words and one end per text, which is the first token's context too. A null or empty text is its end alone. Ids
and texts may repeat; each row counts. A null id is trained on. Without training texts all counts are zero. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T

END = 0x656E64
BASE, BITS, HASHES, PRIOR = 2.0, 8, 4, 500.0
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
BUFFER = 1 << 21


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of lowered texts, an end after each, and each text's first (one entry more than texts)."""
    hashes, at = T.words([t.lower() for t in texts])
    return np.insert(hashes, at[1:], np.uint64(END)), at + np.arange(len(at))


def bigrams(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and bigram hash of every token; the context of a text's first token is the end."""
    context = np.empty_like(hashes)
    context[1:], context[at[:-1]] = hashes[:-1], np.uint64(END)
    return context, T.mix(context * np.uint64(0x9E3779B97F4A7C15) + hashes)


def levels(count: np.ndarray) -> np.ndarray:
    """Level of each count of 1 or more: the rounded logarithm, plus 1."""
    return 1 + np.rint(np.log(count) / np.log(BASE)).astype(np.int64)


def quantised(level: np.ndarray) -> np.ndarray:
    """The counts that levels stand for."""
    return np.where(level > 0, BASE ** (level - 1.0), 0.0)


@dataclass
class Filter:
    """Bits in one segment per shard; an n-gram's segment is fixed by its hash, its places in it by its order, print and level.
    top has the highest level that was entered of each order (counts below 2**63 have no higher ones)."""

    bits: np.ndarray
    first: np.ndarray
    size: np.ndarray
    top: tuple[int, int] = (64, 64)

    @staticmethod
    def places(order: int, prints: np.ndarray, level: int, size: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
        value = T.mix(prints.astype(np.uint64) + np.uint64((2 * level + order) * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = value >> np.uint64(32) | np.uint64(1)
        for k in range(HASHES):
            yield ((value + np.uint64(k) * step) % size).astype(np.int64)

    def has(self, order: int, grams: np.ndarray, level: int) -> np.ndarray:
        shard = (grams % np.uint64(len(self.size))).astype(np.int64)
        out, first = np.ones(len(grams), bool), self.first[shard]
        for place in self.places(order, prints(grams), level, self.size[shard]):
            spot = first + place
            out &= (self.bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0
        return out

    def levels(self, order: int, grams: np.ndarray) -> np.ndarray:
        """Levels, 0 where there is none, by probing one after another."""
        found, left, step = np.zeros(len(grams), np.uint8), np.arange(len(grams)), 0
        while len(left) and step < self.top[order]:
            step += 1
            left = left[self.has(order, grams[left], step)]
            found[left] = step
        return found

    def counts(self, order: int, grams: np.ndarray) -> np.ndarray:
        return quantised(self.levels(order, grams))


def prints(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(32)).astype(np.uint32)


def merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(values, return_inverse=True)
    return found, np.bincount(which, counts, len(found)).astype(np.int64)


def keys(pairs: np.ndarray, shards: int) -> np.ndarray:
    """A bigram's shard and print in one number."""
    return pairs % np.uint64(shards) << np.uint64(32) | pairs >> np.uint64(32)


def by_shard(values: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts hashes by shard and value, and where each shard begins."""
    shard = (values % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((values, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def counted(shards: int):
    """A task's n-gram counts, dealt to shards by hash: one row for each shard, order and buffer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = [[], []]
        size = 0
        for frame in frames:
            for _, texts in T.batches(T.text_column(frame)):
                hashes, at = tokens(texts)
                held[0].append(hashes)
                held[1].append(keys(bigrams(hashes, at)[1], shards))
                size += len(hashes)
                if size > BUFFER:
                    yield dealt(held, shards)
                    held, size = [[], []], 0
        if size:
            yield dealt(held, shards)

    return run


def dealt(held: list[list[np.ndarray]], shards: int) -> pd.DataFrame:
    rows = []
    words, number = np.unique(np.concatenate(held[0]), return_counts=True)
    order, edges = by_shard(words, shards)
    words, number = words[order], number[order].astype(np.uint32)
    rows += [(s, 1, words[a:b].tobytes(), number[a:b].tobytes()) for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
    pairs, number = np.unique(np.concatenate(held[1]), return_counts=True)
    edges = np.searchsorted(pairs, np.arange(shards + 1, dtype=np.uint64) << np.uint64(32))
    own, number = pairs.astype(np.uint32), number.astype(np.uint32)
    rows += [(s, 2, own[a:b].tobytes(), number[a:b].tobytes()) for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
    return pd.DataFrame(rows, columns=["shard", "n", "grams", "counts"])


def built(most_bits: int | None = None):
    """A shard's words with their exact counts, and its segment of the filter: BITS for each entry, or most_bits where that is less."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for n, kind in ((1, np.uint64), (2, np.uint32)):
            own = group[group["n"] == n]
            found.append(merged(np.frombuffer(b"".join(own["grams"]), kind), np.frombuffer(b"".join(own["counts"]), np.uint32)))
        top = [levels(counts) for _, counts in found]
        wanted = BITS * int(sum(t.sum() for t in top))
        size = max(64, -(-(wanted if most_bits is None else min(most_bits, wanted)) // 64) * 64)
        bits = np.zeros(size, np.uint8)
        for order, (values, level) in enumerate(zip((prints(found[0][0]), found[1][0]), top, strict=True)):
            for at in range(1, int(level.max(initial=0)) + 1):
                for place in Filter.places(order, values[level >= at], at, np.uint64(size)):
                    bits[place] = 1
        words, counts = found[0]
        highest = [int(level.max(initial=0)) for level in top]
        row = (group["shard"].iloc[0], words.tobytes(), counts.tobytes(), len(words), int(counts.sum()), np.packbits(bits, bitorder="little").tobytes(), highest)
        return pd.DataFrame([row], columns=["shard", "words", "counts", "distinct", "total", "bits", "top"])

    return run


class Model:
    """Exact word counts and filter segments by shard, stored; and the number of training tokens and of distinct ones."""

    def __init__(self, docs: DataFrame, shards: int):
        training = docs.where(~F.col("held_out")).select("text")
        parts = training.mapInPandas(counted(shards), "shard long, n int, grams binary, counts binary")
        schema = "shard long, words binary, counts binary, distinct long, total long, bits binary, top array<int>"
        self.table = T.written(parts.groupBy("shard").applyInPandas(built(), schema), "ngram_counts")
        sums = self.table.agg(F.sum("total"), F.sum("distinct")).first()
        self.tokens, self.distinct = sums[0] or 0, sums[1] or 0


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, shards = total // BLOCK_BYTES + 1, total // SHARD_BYTES + 1
    doc_id, text = F.col("doc_id").cast("string"), F.coalesce(F.col("text"), F.lit(""))
    block = F.pmod(F.xxhash64(doc_id, F.xxhash64(text)), F.lit(blocks))
    rows = docs.select(block.alias("block"), doc_id.alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text"))
    model = Model(rows, shards)
    train, distinct = model.tokens, model.distinct
    floor = train + 0.5 * (distinct + 1)

    def block_grams(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A block's distinct words by shard and where each shard's begin; and the same of its bigrams, as keys."""
        words = np.unique(np.concatenate([np.unique(hashes) for hashes, _ in held]))
        order, edges = by_shard(words, shards)
        pairs = np.unique(np.concatenate([np.unique(keys(bigrams(*own)[1], shards)) for own in held]))
        return words[order], edges, pairs, np.searchsorted(pairs, np.arange(shards + 1, dtype=np.uint64) << np.uint64(32))

    def block_tokens(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        return [tokens(texts) for _, texts in T.batches(T.text_column(frame))]

    def asked(frame: pd.DataFrame) -> pd.DataFrame:
        words, edges, pairs, borders = block_grams(block_tokens(frame))
        own, block = pairs.astype(np.uint32), frame["block"].iloc[0]
        ends = zip(edges, edges[1:], borders, borders[1:], strict=False)
        rows = [(s, block, words[a:b].tobytes(), own[c:d].tobytes()) for s, (a, b, c, d) in enumerate(ends) if b > a or d > c]
        return pd.DataFrame(rows, columns=["shard", "block", "words", "pairs"])

    def answered(group: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        words, number = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        segment = Filter(np.zeros(8, np.uint8), np.zeros(1, np.int64), np.full(1, 64, np.uint64), (0, 0))  # of a shard without n-grams
        if len(counts):
            row = counts.iloc[0]
            segment = Filter(np.frombuffer(row["bits"], np.uint8), np.zeros(1, np.int64), np.full(1, len(row["bits"]) * 8, np.uint64), tuple(row["top"]))
            if row["words"]:
                words, number = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.int64)
        single, which = np.unique(np.frombuffer(b"".join(group["words"]), np.uint64), return_inverse=True)
        at = np.minimum(np.searchsorted(words, single), len(words) - 1)
        exact, seen = np.where(words[at] == single, number[at], 0)[which], segment.levels(0, single)[which]
        pairs, which = np.unique(np.frombuffer(b"".join(group["pairs"]), np.uint32), return_inverse=True)
        together = segment.levels(1, pairs.astype(np.uint64) << np.uint64(32))[which]
        upto = [np.cumsum([len(raw) // width for raw in group[c]])[:-1] for c, width in (("words", 8), ("pairs", 4))]
        parts = [[x.tobytes() for x in np.split(values, cut)] for values, cut in ((exact, upto[0]), (seen, upto[0]), (together, upto[1]))]
        return pd.DataFrame({"block": group["block"], "shard": group["shard"], "counts": parts[0], "levels": parts[1], "pair_levels": parts[2]})

    def scored(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        held, known = block_tokens(frame), known.sort_values("shard")
        words, _, pairs, _ = block_grams(held)
        number, read, read_pairs = (np.frombuffer(b"".join(known[c]), kind) for c, kind in (("counts", np.int64), ("levels", np.uint8), ("pair_levels", np.uint8)))
        order = np.argsort(words)
        words, number, read, read_pairs = words[order], number[order], quantised(read[order]), quantised(read_pairs)
        end, parts = read[np.searchsorted(words, np.uint64(END))], []
        for hashes, at in held:
            place = np.searchsorted(words, hashes)
            exact, seen = number[place], read[place]
            size = np.diff(at)
            text = np.repeat(np.arange(len(size)), size)
            base = np.log10((exact + 0.5) / floor)
            unigram = (seen + 0.5) / floor
            before = np.empty_like(seen)
            before[1:], before[at[:-1]] = seen[:-1], end
            single, which = np.unique(keys(bigrams(hashes, at)[1], shards), return_inverse=True)
            together = np.minimum(read_pairs[np.searchsorted(pairs, single)][which], np.minimum(before, seen))
            model_score = np.log10((together + PRIOR * unigram) / (before + PRIOR))
            total = [np.bincount(text, x, len(size)) for x in (exact > 0, base, model_score)]
            parts.append(pd.DataFrame({"n_tokens": size, "n_known": total[0].astype(np.int64), "base_score": total[1], "score": np.minimum(total[2], 0)}))
        return pd.concat([frame[["doc_id", "held_out"]].reset_index(drop=True), pd.concat(parts, ignore_index=True)], axis=1)

    by_block = rows.groupBy("block")
    asking = by_block.applyInPandas(asked, "shard long, block long, words binary, pairs binary")
    counts = model.table.select("shard", "words", "counts", "bits", "top")
    answer = "block long, shard long, counts binary, levels binary, pair_levels binary"
    answers = asking.groupBy("shard").cogroup(counts.groupBy("shard")).applyInPandas(answered, answer)
    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = by_block.cogroup(answers.groupBy("block")).applyInPandas(scored, schema)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score"
    )
