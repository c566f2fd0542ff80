"""The source audit beside its plain version."""

import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from eventmill.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, documents=3):
    terms, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        own = TERM.findall((text or "").translate(brute.LOWER))
        terms[lang, source].update(own)
        held[lang].update(set(own))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= documents)

        def shares(count, kept=kept):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        p = {s: shares(terms[lang, s]) for s in sources}
        q = shares(sum((terms[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if terms[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, 200)):
                best = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(best, 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, divergence.divergence(docs, **options).collect()))


def texts(docs):
    return [tuple(r) for r in docs.select("lang", "source", "text").collect()]


@pytest.mark.parametrize("shard, gather, buffer", [(1 << 20, 1 << 20, 1 << 18), (50, 7, 20)])
def test_divergence(docs, monkeypatch, shard, gather, buffer):
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "GATHER", gather)
    monkeypatch.setattr(divergence, "BUFFER", buffer)
    assert found(docs) == plain(texts(docs))


def test_odd_groups(spark, empty):
    rows = [("x", "a", "one two three"), ("x", "b", "one two two"), ("x", "c", "ONE two one one"), ("x", "silent", ""), ("x", None, None), ("y", "a", "nothing kept"), ("y", "b", "here")]
    rows += [(None, None, "null group"), ("", "z", "null group"), (None, "z", "null 7 group_group"), ("alone", "a", "same same"), ("alone", "a", "same"), ("alone", "a", "same"), ("é", "中", "é中 É é中"), ("é", "b", "é中"), ("é", "b", "é中 é中")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "5 as term", "'k' as item", "null as doc_id", "1 as n")
    assert found(docs) == plain(rows)
    assert found(docs, documents=1) == plain(rows, documents=1)
    assert found(empty) == []


def test_only_the_best_terms_are_ranked(spark):
    rows = [("x", s, " ".join(f"t{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}" for i in range(1500) if i % k)) for s, k in (("a", 2), ("b", 3), ("c", 5), ("d", 7))]
    got = found(spark.createDataFrame(rows, "lang string, source string, text string"))
    assert got == plain(rows) and sum(r[2] == "term" for r in got) == 800


def test_shares_do_not_overflow():
    count, whole = np.array([0, 5, 10**15, 9 * 10**15 - 1]), 9 * 10**15
    assert divergence.share(count, whole).tolist() == [1 + 10**9 * (int(c) + 1) // whole for c in count]
