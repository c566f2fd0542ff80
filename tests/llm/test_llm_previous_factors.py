"""Longest previous factors of op8 by hand and beside a plain search over all pairs."""

import random

import numpy as np
import pytest

from eventmill.llm import repeats


def factors(segments, length):
    """Of each segment's windows, from (document, text) pairs."""
    texts = [t for _, t in segments]
    windows = np.array([len(t) - length + 1 for t in texts])
    found = repeats.previous_factors(np.frombuffer(b"".join(texts), np.uint8), windows, np.array([d for d, _ in segments]), length)
    return [x.tolist() for x in np.split(found, np.cumsum(windows)[:-1])]


def plain(segments, length):
    out = []
    for doc, text in segments:
        out.append([])
        for p in range(len(text) - length + 1):
            best = 0
            for other, earlier in segments:
                for q in range(len(earlier)) if other < doc else ():
                    n = 0
                    while p + n < len(text) and q + n < len(earlier) and text[p + n] == earlier[q + n]:
                        n += 1
                    best = max(best, n)
            out[-1].append(best if best >= length else 0)
    return out


def test_by_hand():
    assert factors([(1, b"abcdef"), (2, b"xbcdez"), (3, b"bcdezz")], 3) == [[0, 0, 0, 0], [0, 4, 3, 0], [5, 4, 3, 0]]
    # The nearest suffixes on both sides are of larger documents; the smaller one lies behind them.
    assert factors([(5, b"abcd"), (4, b"abcd"), (1, b"abcc"), (9, b"abcde")], 3) == [[4, 3], [3, 0], [0, 0], [4, 3, 0]]
    # Equal documents are not earlier than each other.
    assert factors([(7, b"aaaa"), (7, b"aaaa")], 2) == [[0, 0, 0], [0, 0, 0]]
    assert factors([(1, b"aaa"), (2, b"aaaaa")], 2) == [[0, 0], [3, 3, 3, 2]]


@pytest.mark.parametrize("length", [2, 3, 8, 11])
def test_beside_all_pairs(length):
    draw = random.Random(length)
    for _ in range(60):
        letters = draw.choice([b"a", b"ab", b"abcd"])
        pieces = [bytes(draw.choices(letters, k=draw.randint(length, 3 * length))) for _ in range(3)]
        segments = [(draw.randint(0, 6), draw.choice(pieces)[draw.randint(0, 1) :] + draw.choice(pieces)) for _ in range(draw.randint(1, 9))]
        assert factors(segments, length) == plain(segments, length)


def test_clashing_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(repeats.T, "prefix_sums", lambda data: np.zeros(len(data) + 1, np.uint64))
    segments = [(1, b"abcdefghij"), (2, b"zbcdefghiz"), (3, b"qqqqqqqqqq")]
    assert factors(segments, 5) == plain(segments, 5)
