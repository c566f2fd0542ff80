"""The log-frequency filter at any size: probed where its segments lie, with the same bits for every entry."""

import math
from collections import Counter

import brute
import numpy as np
import pandas as pd

from eventmill.llm import lm_scoring


def test_a_full_segment_ends_at_the_highest_level():
    full = lm_scoring.Filter(np.full(8, 255, np.uint8), np.zeros(1, np.int64), np.full(1, 64, np.uint64), (3, 5))
    grams = np.arange(10, dtype=np.uint64) << np.uint64(40)
    assert set(full.levels(0, grams)) == {3} and set(full.counts(1, grams)) == {lm_scoring.BASE**4}


def test_a_segment_has_bits_for_each_entry():
    grams = np.random.default_rng(2).integers(0, 2**63, 300_000).astype(np.uint64)
    numbers = np.full(len(grams), 5, np.uint32).tobytes()
    rows = [(0, 1, grams.tobytes(), numbers), (0, 2, lm_scoring.prints(grams).tobytes(), numbers)]
    row = lm_scoring.built()(pd.DataFrame(rows, columns=["shard", "n", "grams", "counts"])).iloc[0]
    entries = int(lm_scoring.levels(np.array([5]))[0]) * (len(grams) + len(np.unique(lm_scoring.prints(grams))))
    assert len(row["bits"]) * 8 >= lm_scoring.BITS * entries and row["top"][0] == 3


def test_scores_without_a_broadcast(spark, odd, monkeypatch):
    """Many blocks and shards; the scores are those of exactly known levels but for the filter's false positives."""

    def refused(*_):
        raise AssertionError("the filter must not be gathered")

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refused)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 3000)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    found = lm_scoring.score(odd).collect()
    expected = brute.lm(rows)
    assert sorted((tuple(r[:5]) for r in found), key=repr) == sorted((tuple(x[:5]) for x in expected), key=repr)
    texts = [[None, *brute.words((t or "").translate(brute.LOWER)), None] for _, t in rows]
    trained = [t for t, x in zip(texts, expected, strict=True) if not x[1]]
    one, two = Counter(w for t in trained for w in t[1:]), Counter(p for t in trained for p in zip(t, t[1:], strict=False))
    floor = sum(one.values()) + 0.5 * (len(one) + 1)

    def count(counter, key):
        return lm_scoring.BASE ** float(np.rint(math.log2(counter[key]))) if counter[key] else 0.0

    def score(t):
        pairs = list(zip(t, t[1:], strict=False))
        joint = [min(count(two, p), count(one, p[0]), count(one, p[1])) for p in pairs]
        prior = lm_scoring.PRIOR
        return min(0.0, sum(math.log10((j + prior * (count(one, b) + 0.5) / floor) / (count(one, a) + prior)) for j, (a, b) in zip(joint, pairs, strict=True)))

    by_hand = sorted(map(score, texts))
    read = sorted(r["score"] for r in found)
    assert abs(sum(read) - sum(by_hand)) <= 0.02 * abs(sum(by_hand))
