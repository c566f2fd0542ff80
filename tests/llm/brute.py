"""Plain reference versions of the operators, over (doc_id, text) pairs held in memory."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality(rows):
    out = []
    for doc_id, text in rows:
        w = words(text)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count = Counter(windows)
        again = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 5)}
        lines, seen, dup = (text or "").split("\n"), set(), 0
        for line in lines:
            dup += bool(words(line)) and line in seen
            seen.add(line)
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again), failed))
    return out


def lm(rows):
    def tokens(text):
        return [*words((text or "").translate(LOWER)), None]

    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    count = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for (doc_id, text), h in zip(rows, held):
        own = tokens(text)
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((doc_id, h, len(own), sum(count[t] > 0 for t in own), n, base))
    return out


def pieces(rows, encode):
    out = []
    for doc_id, text in rows:
        ids = [*encode(text or ""), 2]
        first = len(ids) % 1024
        edges = [0] * (first > 0) + list(range(first, len(ids) + 1, 1024))
        for k, (a, b) in enumerate(itertools.pairwise(edges)):
            raw = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            out.append((doc_id, k, a, b - a, zlib.crc32(raw)))
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] += [doc_id] * (doc_id is not None)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = (min(least[find(i)]) if least[find(i)] else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def repeats(rows, length=50):
    first = {}
    key = [math.inf if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    for k, t in zip(key, texts):
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(k, first.get(s, math.inf))
    out = []
    for (doc_id, _), k, t in zip(rows, key, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < k:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for x, _ in itertools.groupby(gone) if x)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_licenses(rows):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    out = []
    for doc_id, text in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        labels = ",".join(sorted({x for _, x in at}))
        out.append((doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None), labels))
    return out
