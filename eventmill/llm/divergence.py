"""Audit of how the sources of a language differ, by Gustavson row accumulation over a term-major index.

A language keeps the terms that at least DOCUMENTS of its documents hold. A group (language and source) gives each kept term a smoothed share
p = 1 + floor(SCALE (count + 1) / (N + V)), and differs from a peer by the sum of floor((p - q)^2 / q) over all kept terms.

1. Tasks count terms by group and, for the language, the documents that hold them; the counts meet by term, which is the term-major index:
   every kept term with its postings, one for each source that has it.
2. The index is dealt to shards by term. In a shard every group goes through the postings of its own terms and adds to one dense accumulator
   over its peers; pairs of postings are never rows. What is added corrects the value that the term would have with no count on either side.
3. Those baselines come from histograms: a share depends on the count alone, so a group's terms with equal counts are one case for each peer.
4. The terms where a group is above its language are ranked in the same pass: each shard gives the best of each group, and these are ranked again.

All numbers are whole; sums are modulo 2**64 and so exact wherever the result fits. A null language, source or text counts as ''. Every row is a
document of its own, whatever its id. A group without terms has its pairs, a language without kept terms has pairs of value 0 and no terms;
a language with one source has no pairs. Empty tables give no rows; only text, lang and source are read. One term's postings and one
group's peers are as many as the language has sources, and are held in one task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm import text as T

#: On bytes, A-Z lowered: letters of ASCII and all bytes of other characters.
TERM = re.compile(rb"[a-z\x80-\xff]+")
DOCUMENTS, SCALE_STEPS, STEP, BEST = 3, 3, 1000, 200
#: Terms that a task holds before it hands them on, postings of a shard, and postings gathered at once.
BUFFER, SHARD, GATHER = 1 << 18, 1 << 20, 1 << 20
FOUND = "lang string, source string, part string, item string, value long"


def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """lang, source, term, n (occurrences) and documents, combined within a task as far as its buffer goes."""
    n: dict[tuple[str, str], Counter] = defaultdict(Counter)
    documents: dict[tuple[str, str], Counter] = defaultdict(Counter)
    held = 0

    def flushed() -> pd.DataFrame:
        rows = [(*group, t.decode("utf-8", "surrogatepass"), c, documents[group][t]) for group, own in n.items() for t, c in own.items()]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "documents"])

    for frame in frames:
        for lang, source, text in zip(frame["lang"], frame["source"], frame["text"], strict=True):
            words, group = TERM.findall(T.utf8(text).lower()), (lang, source)
            before = len(n[group])
            n[group].update(words)
            documents[group].update(set(words))
            held += len(n[group]) - before
            if held > BUFFER:
                yield flushed()
                n.clear()
                documents.clear()
                held = 0
    if held:
        yield flushed()


def share(count: np.ndarray | int, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 (count + 1) / whole), digit group by digit group so that nothing overflows."""
    out, rest = np.divmod(np.asarray(count, np.int64) + 1, whole)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * STEP, whole)
        out = out * STEP + digits
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] times, then the same for the next."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def rows_of(lang: str, sources: list[str], part: str, items: list[str], values: np.ndarray) -> list[tuple]:
    return [(lang, s, part, i, v) for s, i, v in zip(sources, items, values.tolist(), strict=True)]


def frame_of(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")], dtype=object)


def gathered(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive rows whose sizes sum to about GATHER, one at least."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + GATHER, "right")))
        yield slice(a, b)
        a = b


def accumulated(key: tuple, terms: pd.DataFrame, language: pd.DataFrame) -> pd.DataFrame:
    """One shard: corrections of each pair of its groups, and the best terms of each group."""
    if terms.empty or language.empty:
        return frame_of([])
    whole = language.iloc[0]
    terms = terms.assign(raw=[t.encode("utf-8", "surrogatepass") for t in terms["term"]]).sort_values("raw", ignore_index=True)
    sources, names = pd.Index(whole["sources"]), np.array(terms["term"], object)
    v, totals = int(whole["v"]), np.asarray(whole["totals"], np.int64)
    size = terms["counts"].map(len).to_numpy(np.int64)
    at, term = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
    group, count = sources.get_indexer(np.concatenate(list(terms["sources"]))), np.concatenate(list(terms["counts"])).astype(np.int64)
    p, base = share(count, totals[group] + v), share(0, totals + v)
    overall = share(terms["n"].to_numpy(np.int64), int(whole["n"]) + v)
    by_group = np.lexsort((term, group))
    edges, out = np.searchsorted(group[by_group], np.arange(len(sources) + 1)), []
    for g in np.flatnonzero(np.diff(edges)):
        own = by_group[edges[g] : edges[g + 1]]
        neither, met, total = distance(base[g], base), np.zeros(len(sources), bool), np.zeros(len(sources), np.int64)
        for part in gathered(size[term[own]]):
            some = own[part]
            entry = spread(at[term[some]], size[term[some]])
            mine, peer, theirs = np.repeat(p[some], size[term[some]]), group[entry], p[entry]
            np.add.at(total, peer, distance(mine, theirs) - distance(mine, base[peer]) - distance(base[g], theirs) + neither[peer])
            met[peer] = True
        met[g] = False
        out += rows_of(key[0], [sources[g]] * int(met.sum()), "pair", list(sources[met]), total[met])
        above = own[p[own] > overall[term[own]]]
        value = distance(p[above], overall[term[above]])
        best = np.lexsort((term[above], -value))[:BEST]
        out += rows_of(key[0], [sources[g]] * len(best), "term", list(names[term[above[best]]]), value[best])
    return frame_of(out)


def baselines(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """One group and each peer, as if they shared no term: this side's part of both directions, and the terms of neither."""
    own = group.iloc[0]
    sources, totals, sizes, v = pd.Index(own["sources"]), np.asarray(own["totals"], np.int64), np.asarray(own["sizes"], np.int64), int(own["v"])
    g, lang = sources.get_loc(key[1]), key[0]
    there, back = np.zeros(len(sources), np.int64), np.zeros(len(sources), np.int64)
    if v:
        base = share(0, totals + v)
        counts, number = (np.asarray([] if own[c] is None else own[c], np.int64) for c in ("counts", "number"))
        p = share(counts, totals[g] + v)
        for part in gathered(np.full(len(counts), len(sources))):
            there += (number[part, None] * distance(p[part, None], base[None])).sum(0)
            back += (number[part, None] * distance(base[None], p[part, None])).sum(0)
        there += (v - sizes[g] - sizes) * distance(base[g], base)
    others = np.arange(len(sources)) != g
    peers = list(sources[others])
    own_name = [key[1]] * len(peers)
    return frame_of(rows_of(lang, own_name, "pair", peers, there[others]) + rows_of(lang, peers, "pair", own_name, back[others]))


def term_index(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, term, sources and counts (its postings) and n (their sum) of every kept term, stored."""
    parts = docs.mapInPandas(counted, "lang string, source string, term string, n long, documents long")
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    terms = counts.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("postings"), F.sum("documents").alias("documents"), F.sum("n").alias("n"))
    kept = terms.where(F.col("documents") >= documents)
    return T.written(kept.select("lang", "term", F.col("postings.source").alias("sources"), F.col("postings.n").alias("counts"), "n"), "term_index")


def divergence(docs: DataFrame, documents: int = DOCUMENTS, best: int = BEST) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank. best may be BEST at most."""
    if best > BEST:
        raise ValueError(f"shards give the best {BEST} terms of a group")
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    index = term_index(read, documents)
    held = index.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
    equal = held.groupBy("lang", "source", "count").agg(F.count("*").alias("number"))
    totals = T.written(
        equal.groupBy("lang", "source").agg(
            F.sum(F.col("count") * F.col("number")).alias("total"), F.sum("number").alias("size"), F.collect_list(F.struct("count", "number")).alias("equal")
        ),
        "group_totals",
    )
    languages = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    groups = T.written(read.select("lang", "source").distinct().join(totals.hint("merge"), ["lang", "source"], "left"), "groups")
    filled = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size"))
    listed = filled.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total", "size"))).alias("all"))
    vectors = T.written(
        listed.join(languages.hint("merge"), "lang", "left").select(
            "lang", F.col("all.source").alias("sources"), F.col("all.total").alias("totals"), F.col("all.size").alias("sizes"),
            F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n"),
        ),
        "languages",
    )

    shards = (index.agg(F.sum(F.size("counts"))).first()[0] or 0) // SHARD + 1
    dealt = index.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)))
    each = vectors.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    sums = T.written(dealt.groupBy("lang", "shard").cogroup(each.groupBy("lang", "shard")).applyInPandas(accumulated, FOUND), "sums")
    own = groups.select("lang", "source", F.col("equal.count").alias("counts"), F.col("equal.number").alias("number"))
    apart = own.join(vectors.hint("merge"), "lang").groupBy("lang", "source").applyInPandas(baselines, FOUND)

    pairs = sums.where("part = 'pair'").union(apart).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(ranking)) for x in (pairs, sums.where("part = 'term'"))]
    return ranked[0].union(ranked[1].where(F.col("rank") <= best))
