"""Importance resampling beside a plain version with its own n-grams, counts, weights and Gumbel values."""

import math
import re
import struct
from collections import Counter
from functools import lru_cache

import xxhash

from eventmill.llm import quality, resampling


@lru_cache(maxsize=None)
def bucket(gram):
    """Only the hash of a single n-gram is taken from the operator: its place is the last of the n-grams of its own text."""
    return int(quality.buckets([" ".join(gram).encode()])[2][-1])


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [bucket(g) for g in [(w,) for w in words] + list(zip(words, words[1:]))], len(words)


def variate(doc_id):
    """Minus the log of minus the log of a uniform number from the 64-bit hash of a label and the id (a null id: of the label)."""
    state = xxhash.xxh64_intdigest(b"gumbel", 42)
    if doc_id is not None:
        state = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), state)
    return -math.log(-math.log((state % 2**48 + 0.5) / 2**48))


def plain(rows, trusted, share):
    raw, good = Counter(), Counter()
    for doc_id, text in rows:
        found = grams(text)[0]
        raw.update(found)
        if doc_id in trusted:
            good.update(found)
    totals = [sum(c.values()) + quality.BUCKETS for c in (good, raw)]
    out = []
    for doc_id, text in rows:
        found, n = grams(text)
        weight = sum(math.log((good[b] + 1) / totals[0]) - math.log((raw[b] + 1) / totals[1]) for b in found) if good else 0.0
        out.append((doc_id, n, weight, weight + variate(doc_id)))
    # The sample stops short of k rather than split equal sums.
    sums, k = sorted((x[3] for x in out), reverse=True), int(share * len(out))
    least = -math.inf if k >= len(sums) else min((s for s in sums[:k] if s > sums[k] + 1e-9), default=math.inf)
    return [(doc_id, n, weight, total >= least - 1e-9) for doc_id, n, weight, total in out]


def test_every_row_as_in_the_plain_version(spark, docs, labels):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    target = quality.trusted_ids(labels)
    trusted = {r["doc_id"] for r in target.collect()}
    for share in (0.1, 0.25, 0.7):
        found = [tuple(r) for r in resampling.resample(docs, target, share).select("doc_id", "n_words", "log_weight", "sampled").collect()]
        expected = plain(rows, trusted, share)

        def key(row):
            return repr(row[0]), row[1], round(row[2], 5)

        found, expected = sorted(found, key=key), sorted(expected, key=key)
        assert [(r[0], r[1], r[3]) for r in found] == [(r[0], r[1], r[3]) for r in expected]
        assert all(math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-6) for a, b in zip(found, expected))


def test_without_trusted_texts_the_variates_decide(odd, nothing_trusted):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    found = resampling.resample(odd, nothing_trusted, 0.3).collect()
    assert all(r["log_weight"] == 0 for r in found)
    expected = plain(rows, set(), 0.3)
    assert sorted((repr(r["doc_id"]), r["sampled"]) for r in found) == sorted((repr(x[0]), x[3]) for x in expected)
