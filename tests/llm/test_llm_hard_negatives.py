"""Hard negatives beside their plain version."""

import math
import random

import numpy as np
import pytest

from eventmill.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score int, slot int, block int"


def plain(rows, every=50, positives=5, negatives=3):
    known = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        known[i] = min(known.get(i, (label, v)), (label, v))
    whole = {i: [math.floor(256 * x) for x in v] for i, (_, v) in known.items()}
    out = []
    for a in known:
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(whole[a], v)) for i, v in whole.items()}
        ranked = sorted((i for i in known if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in ranked if known[i][0] == known[a][0]][:positives]:
            own = [i for i in ranked if known[i][0] != known[a][0] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, k, n, score[p], score[n]) for k, n in enumerate(own[:negatives], 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, hard_negatives.hard_negatives(docs, **options).collect()))


def made(seed, n, width, labels=10):
    """Vectors of many lengths around a few directions, on a coarse grid so that scores tie."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        size = rng.choice([0.05, 0.3, 1, 1, 4])
        rows.append((i, [round(size * (c + rng.gauss(0, 0.4)) * 8) / 8 for c in rng.choice(centres)], rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("seed, block, bucket, anchors", [(1, 8192, 1024, 2048), (2, 100, 16, 4), (3, 150, 32, 7)])
def test_hard_negatives(spark, monkeypatch, seed, block, bucket, anchors):
    for name, value in (("BLOCK", block), ("BUCKET", bucket), ("ANCHORS", anchors)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = made(seed, 700, 6, labels=3)
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    expected = plain(rows, every=10)
    assert expected and found(docs, every=10) == expected


def test_odd_rows(spark):
    rows = made(5, 120, 5, labels=2)
    rows += [(1000, None, 1), (1050, [], 1), (1100, [1.0, None], 1), (1150, [float("nan")], 0), (1200, [float("inf"), 1.0], 0), (1250, [0.0] * 5, 0), (1300, [1.0, 2.0], None), (1350, [2.0, 1.0], 1), (1400, [1.0] * 9, 0)]
    rows += [(None, [1.0] * 5, 1), (1450, [3.0] * 5, 1), (1450, [1.0] * 5, 0), (1500, [1.5] * 5, 1), (1500, [1.5] * 5, 1), (-50, [1.25] * 5, -1), (-7, [1.0] * 5, -1), (-49, [1.0] * 5, -2)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows * 2], SCHEMA).repartition(4)
    assert found(docs) == plain(rows)
    assert found(docs.where("false")) == [] and found(docs.where("vec_id % 50 > 0")) == []


def test_large_components(spark):
    large = [(i, [float(1 << 17) * (1 + i % 5), -3.0, float(1 << 12) * (i % 9)], i % 3) for i in range(60)]  # scores are multiples of 2**16
    assert plain(large) and found(spark.createDataFrame([(*r, 1, 2, 3) for r in large], SCHEMA)) == plain(large)
    beyond = [(i, [1e15 * (1 + i % 5), -3.0, 1e14], i % 3) for i in range(60)]  # all scores are a long's end, which is no share of itself
    assert found(spark.createDataFrame([(*r, 1, 2, 3) for r in beyond], SCHEMA)) == []


def test_one_vector_repeated_many_times(spark):
    rows = made(9, 400, 4, labels=3) + [(1000 + i, [1.0, 0.5, -0.25, 2.0], i % 3) for i in range(600)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    assert found(docs) == plain(rows)


def test_feasible_ranges_leave_out_only_what_cannot_reach():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.normal(size=(1000, 6)) * rng.choice([0.9, 1, 1.1], (1000, 1)))
    rows = np.floor(rows / np.linalg.norm(rows, axis=1, keepdims=True) * rng.choice([900, 1000], (1000, 1)))
    rows[:5] = 0
    unit = hard_negatives.normalised(rows, hard_negatives.lengths(rows))
    bucket = hard_negatives.Bucket(np.arange(1000), np.zeros(1000, int), rows, np.argsort(unit, axis=0, kind="stable").astype(np.uint16))
    anchors = hard_negatives.Anchors(np.arange(40), np.zeros(40, int), rows[:40])
    exact = rows[:40] @ rows.T
    left_out = 0
    for share in (-0.5, 0.0, 0.2, 0.5, 0.9, 1.0, 1.1):
        needed = share * exact.max(1)
        scores = bucket.scores(anchors, needed)
        gone = np.isneginf(scores)
        assert (exact[gone] < np.broadcast_to(needed[:, None], gone.shape)[gone]).all() and (scores[~gone] == exact[~gone]).all()
        left_out += gone.sum()
    assert left_out > 0.25 * 7 * exact.size


def test_windows_are_whole():
    score = np.array([-3, 0, 1, 2, 7, 99, 100, 101, 12345, (1 << 62) + 1])
    low, high = hard_negatives.window(score, 50, 95)
    assert low.tolist() == [-(-int(s) * 50 // 100) for s in score] and high.tolist() == [int(s) * 95 // 100 for s in score]
