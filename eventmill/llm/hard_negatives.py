"""Hard negatives by length buckets with sorted coordinate lists, whose feasible ranges are intersected before exact verification.

For each anchor the POSITIVES best other rows of its label are found, and for each of those the NEGATIVES best rows of other labels whose score
lies between two shares of the positive's. Scores are whole inner products of components floor(SCALE x); ties go to the smaller vec_id.

1. Vectors are dealt to blocks by hash. A block orders its rows by length and cuts them into buckets; a bucket holds, for every coordinate, its
   rows in the order of their normalised values.
2. Anchors are blocks too, and every block of rows meets every block of anchors in a task of its own. Against a bucket an anchor needs a score:
   the least one that could still enter its list. With the bucket's lengths that is an angle, and a row inside this angle has, at each of the
   anchor's FOCUS largest coordinates, a value in a range around the anchor's own: the feasible range, found in the sorted list.
   No bucket whose longest row is too short is looked at; the shortest range is cut down by the others, and what is left is verified exactly.
   Where even the shortest range holds most of a bucket, all of the bucket is verified, which is cheaper than cutting.
3. Each task keeps a few rows for each anchor; these are ranked once more over all tasks. Ranges and limits only leave out rows that cannot
   enter a list, so the result is that of comparing every anchor with every row.

Rows without vec_id, label or vector, or with a null or non-finite component, take no part. A vec_id names one row: of rows that share one, the
least (label, vector) stands for all. A shorter vector is filled up with zeros. Equal vectors are ranked by vec_id. Scores of 2**53
and more are rounded once to a double, and beyond a long count as its ends. Empty tables, tables without anchors and anchors without a positive or a negative give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm import text as T

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
#: A negative's score lies between LEAST and MOST percent of its positive's.
LEAST, MOST = 50, 95
BLOCK, BUCKET, ANCHORS, FOCUS = 8192, 1024, 2048, 4
#: Ranges that hold at most one row in so many of a bucket are cut down; wider ones are verified whole.
NARROW = 4
#: Below it, a score times a bucket's rows is exact in a double.
PLAIN = float(1 << 42)
SLACK = 1e-9
PACKED = "block long, ids binary, labels binary, vectors binary, places binary, width int"
FOUND = "anchor_id long, other_id long, score long, slot int"
LAST = np.iinfo(np.int64).max


def eligible(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that take part; the label is shifted where vec_id is divisible by 7."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    turned = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.where(vec_id.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    one = rows.select(vec_id.alias("vec_id"), F.struct(turned.alias("label"), F.col("embedding").cast("array<double>").alias("vector")).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Whole components, one row each, short ones filled up with zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, own in enumerate(vectors):
        out[i, : len(own)] = own
    return np.floor(SCALE * out)


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(1))


def normalised(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.divide(rows, length[:, None], out=np.zeros_like(rows), where=length[:, None] > 0)


def indexed(group: pd.DataFrame) -> pd.DataFrame:
    """A block: rows from long to short, by id inside each bucket, and each bucket's order by every coordinate."""
    rows, ids = matrix(list(group["vector"])), group["vec_id"].to_numpy(np.int64)
    order = np.lexsort((ids, -lengths(rows)))
    order = np.concatenate([order[a : a + BUCKET][np.argsort(ids[order[a : a + BUCKET]])] for a in range(0, len(order), BUCKET)])
    rows = rows[order]
    unit = normalised(rows, lengths(rows))
    places = [np.argsort(unit[a : a + BUCKET], axis=0, kind="stable").astype(np.uint16).tobytes() for a in range(0, len(rows), BUCKET)]
    own = (group["block"].iloc[0], ids[order].tobytes(), group["label"].to_numpy(np.int64)[order].tobytes(), rows.tobytes(), b"".join(places), rows.shape[1])
    return pd.DataFrame([own], columns=["block", "ids", "labels", "vectors", "places", "width"])


class Bucket:
    """Rows of similar length with, per coordinate, their order by normalised value."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, places: np.ndarray):
        self.ids, self.labels, self.rows, self.places = ids, labels, rows, places
        length = lengths(rows)
        self.longest, self.shortest = float(length.max()), float(length.min())
        self.sorted = np.take_along_axis(normalised(rows, length), places.astype(np.int64), axis=0)
        self.rank = np.empty(places.shape, np.int64)
        np.put_along_axis(self.rank, places.astype(np.int64), np.arange(len(ids))[:, None], axis=0)

    def scores(self, anchors: "Anchors", needed: np.ndarray) -> np.ndarray:
        """Scores of each anchor with each row; minus infinity where the row cannot reach what the anchor needs."""
        n, out = len(self.ids), np.full((len(needed), len(self.ids)), -np.inf)
        reach = anchors.length * np.where(needed > 0, self.longest, self.shortest)
        none = np.where(needed > 0, np.inf, -np.inf)
        with np.errstate(invalid="ignore"):
            cosine = np.divide(needed, reach, out=none, where=reach > 0)
        inside = np.flatnonzero(cosine <= 1 + SLACK)
        if not len(inside):
            return out
        angle = np.arccos(np.clip(cosine[inside] - SLACK, -1, 1))[:, None]
        own = np.arccos(np.clip(anchors.focus_value[inside], -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - SLACK, np.cos(np.maximum(0, own - angle)) + SLACK
        start, end = np.zeros(low.shape, np.int64), np.full(low.shape, n)
        focus = anchors.focus[inside]
        for f in np.unique(focus):
            here = focus == f
            start[here], end[here] = np.searchsorted(self.sorted[:, f], low[here]), np.searchsorted(self.sorted[:, f], high[here], "right")
        width = end - start
        narrow = width.min(1, initial=n) <= n // NARROW
        whole = inside[~narrow]
        out[whole] = product(anchors.rows[whole], self.rows)
        for i in np.flatnonzero(narrow):
            first, *rest = np.argsort(width[i], kind="stable")
            found = self.places[start[i, first] : end[i, first], focus[i, first]].astype(np.int64)
            for k in rest:
                rank = self.rank[found, focus[i, k]]
                found = found[(rank >= start[i, k]) & (rank < end[i, k])]
            if len(found):
                out[inside[i], found] = product(anchors.rows[inside[i] : inside[i] + 1], self.rows[found])[0]
        return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products, computed exactly and then rounded to doubles; beyond a long its ends."""
    if not len(a) or not len(b) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < PLAIN:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -LAST, LAST).astype(float)


class Anchors:
    """Anchors with the coordinates that are looked at first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows, self.length = ids, labels, rows, lengths(rows)
        unit = normalised(rows, self.length)
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.focus_value = np.take_along_axis(unit, self.focus, axis=1)


class Best:
    """The k best rows of each list so far, by score and then id."""

    def __init__(self, lists: int, k: int):
        self.score, self.id = np.full((lists, k), -np.inf), np.full((lists, k), LAST)

    def needed(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """scores (one row per list of which, minus infinity: none) of rows in ascending order of id."""
        k = self.score.shape[1]
        live = scores.max(1, initial=-np.inf) >= np.maximum(self.needed()[which], -np.finfo(float).max)
        which, scores = which[live], scores[live]
        if not len(which):
            return
        n = scores.shape[1]
        if n > k:
            if np.abs(scores[np.isfinite(scores)]).max() < PLAIN:
                at = np.argpartition(scores * n - np.arange(n), n - k, axis=1)[:, n - k :]
            else:
                at = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            ids, scores = ids[at], np.take_along_axis(scores, at, axis=1)
        else:
            ids = np.broadcast_to(ids, scores.shape)
        ids = np.where(np.isfinite(scores), ids, LAST)
        both, names = np.concatenate((self.score[which], scores), axis=1), np.concatenate((self.id[which], ids), axis=1)
        order = np.lexsort((names, -both), axis=-1)[:, :k]
        self.score[which], self.id[which] = np.take_along_axis(both, order, axis=1), np.take_along_axis(names, order, axis=1)


def unpacked(block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row = block.iloc[0]
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    width = int(row["width"])
    return ids, labels, np.frombuffer(row["vectors"], float).reshape(len(ids), width), np.frombuffer(row["places"], np.uint16).reshape(len(ids), width)


def both_sides(block: pd.DataFrame, against: pd.DataFrame) -> tuple[list[Bucket], Anchors]:
    """A block's buckets and a block's anchors, with as many coordinates as the wider has."""
    ids, labels, rows, places = unpacked(block)
    own = unpacked(against)
    width = max(rows.shape[1], own[2].shape[1])

    def widened(values: np.ndarray) -> np.ndarray:
        return np.pad(values, ((0, 0), (0, width - values.shape[1])))

    if width > rows.shape[1]:  # equal values, in any order
        more = np.concatenate([np.tile(np.arange(len(ids[a : a + BUCKET]), dtype=np.uint16)[:, None], (1, width - rows.shape[1])) for a in range(0, len(ids), BUCKET)])
        places = np.concatenate((places, more), axis=1)
    rows = widened(rows)
    buckets = [Bucket(*(x[a : a + BUCKET] for x in (ids, labels, rows, places))) for a in range(0, len(ids), BUCKET)]
    return buckets, Anchors(own[0], own[1], widened(own[2]))


def listed(anchors: Anchors, best: Best, slots: int) -> pd.DataFrame:
    lists, k = np.nonzero(np.isfinite(best.score))
    score = np.clip(best.score[lists, k], -float(1 << 63), np.nextafter(float(1 << 63), 0)).astype(np.int64)
    return pd.DataFrame({"anchor_id": anchors.ids[lists // slots], "other_id": best.id[lists, k], "score": score, "slot": (lists % slots).astype(np.int32)})


EMPTY = pd.DataFrame(columns=["anchor_id", "other_id", "score", "slot"])


def positives_in(k: int):
    def run(block: pd.DataFrame, against: pd.DataFrame) -> pd.DataFrame:
        if block.empty or against.empty:
            return EMPTY
        buckets, anchors = both_sides(block, against)
        best, every = Best(len(anchors.ids), k), np.arange(len(anchors.ids))
        for bucket in buckets:
            scores = bucket.scores(anchors, best.needed())
            scores[(anchors.labels[:, None] != bucket.labels) | (anchors.ids[:, None] == bucket.ids)] = -np.inf
            best.add(every, bucket.ids, scores)
        return listed(anchors, best, 1)

    return run


def window(score: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest whole scores between two percentages of a whole score, without overflow."""
    tens, rest = np.divmod(score, 100)
    return tens * least - (-rest * least // 100), tens * most + rest * most // 100


def negatives_in(k: int, slots: int, least: int, most: int):
    def run(block: pd.DataFrame, against: pd.DataFrame) -> pd.DataFrame:
        if block.empty or against.empty:
            return EMPTY
        buckets, anchors = both_sides(block, against)
        given = np.frombuffer(against["scores"].iloc[0], np.int64).reshape(-1, slots)  # -1, which no score can match, where there is no positive
        low, high = (x.astype(float) for x in window(given, least, most))
        lists = np.arange(given.size).reshape(given.shape)
        best = Best(given.size, k)
        for bucket in buckets:
            floor = np.maximum(low, best.needed().reshape(given.shape))
            # A list without a window needs more than any score.
            scores = bucket.scores(anchors, np.where(low <= high, floor, np.inf).min(1))
            scores[anchors.labels[:, None] == bucket.labels] = -np.inf
            for slot in range(slots):
                open_lists = np.flatnonzero(low[:, slot] <= high[:, slot])
                own = scores[open_lists]
                own = np.where((own >= floor[open_lists, slot, None]) & (own <= high[open_lists, slot, None]), own, -np.inf)
                best.add(lists[open_lists, slot], bucket.ids, own)
        return listed(anchors, best, slots)

    return run


def packed_anchors(slots: int):
    """A block of anchors, with the scores of their positives by rank."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows, scores = matrix(list(group["vector"])), np.full((len(group), slots), -1, np.int64)
        if "scores" in group:
            for i, own in enumerate(group["scores"]):
                scores[i, : len(own)] = own
        places = np.zeros(rows.shape, np.uint16)
        own = (group["block"].iloc[0], group["vec_id"].to_numpy(np.int64).tobytes(), group["label"].to_numpy(np.int64).tobytes(), rows.tobytes(), places.tobytes(), rows.shape[1], scores.tobytes())
        return pd.DataFrame([own], columns=["against", "ids", "labels", "vectors", "places", "width", "scores"])

    return run


def met(index: DataFrame, blocks: int, anchors: DataFrame, parts: int, slots: int, run) -> DataFrame:
    """Each block of rows with each block of anchors, as one task each."""
    packed = anchors.groupBy("block").applyInPandas(packed_anchors(slots), PACKED.replace("block", "against") + ", scores binary")
    packed = T.written(packed, "anchors").withColumn("block", F.explode(numbers(blocks)))
    both = ["block", "against"]
    return index.withColumn("against", F.explode(numbers(parts))).groupBy(*both).cogroup(packed.groupBy(*both)).applyInPandas(run, FOUND)


def numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))


def hard_negatives(
    vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every row whose vec_id is divisible by `every`."""
    rows = T.written(eligible(vectors), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks, parts = rows.count() // BLOCK + 1, asked.count() // ANCHORS + 1
    index = T.written(dealt(rows, blocks).groupBy("block").applyInPandas(indexed, PACKED), "vector_index")
    anchors = dealt(asked, parts)
    by_score = F.col("score").desc(), F.col("other_id")
    near = met(index, blocks, anchors, parts, positives, positives_in(positives))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id").orderBy(*by_score))).where(F.col("rank") <= positives)
    chosen = T.written(ranked.select("anchor_id", "other_id", "score", "rank"), "positives")

    lists = chosen.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    with_scores = anchors.join(lists.withColumnRenamed("anchor_id", "vec_id").hint("merge"), "vec_id")
    far = met(index, blocks, with_scores, parts, positives, negatives_in(negatives, positives, least, most))
    order = Window.partitionBy("anchor_id", "slot").orderBy(*by_score)
    kept = far.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= negatives)
    own = chosen.select(F.col("anchor_id").alias("own"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("place"))
    found = kept.join(own.hint("merge"), (F.col("anchor_id") == F.col("own")) & (F.col("slot") == F.col("place")))
    return found.select("anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
