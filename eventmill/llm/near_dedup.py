"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

A document's set holds its distinct shingles of five words (A-Z lowered). Documents with equal sets are one node. SuperMinHash gives a node's
signature: in round j every shingle offers its j-th rank to one position of its own pseudo-random permutation, and rounds stop as
soon as no later rank can be lower. Nodes that agree on all rows of a band are candidates; there are so many bands that a pair at the
threshold is missed with a probability of at most MISS. Candidates are verified on whole sets, so no false link remains.

Verification works by family, which is a component of candidates. Families up to FAMILY nodes and FAMILY_SHINGLES shingles are verified and
grouped in one task each. In larger ones all nodes of a bucket are first verified against a few leaders of it, chunk by chunk, which joins
a large group of copies of one text at a cost in proportion to its size. Nodes that stay outside their bucket's largest group are
then verified against the whole bucket. Only pairs already known to be in one group are left out, and pairs that are no links are never emitted.

A null text counts as empty. A document without words has an empty set, is linked with nothing and stays. Null ids are no ids: a group's
component_id is its smallest id that is not null, and a row with a null id is kept only if its whole group has none. Rows that repeat a
document's id are that document; `one_of_each` keeps one row of a group, whatever its ids. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T
from eventmill.llm.components import components

SHINGLE, PERCENT, ROWS, MISS = 5, 85, 4, 1e-5
FAMILY, FAMILY_SHINGLES, CHUNK, LEADERS = 4096, 1 << 20, 512, 4
ELEMENTS = 1 << 17


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of so many rows after which a pair at the threshold has met with a probability of 1 - miss."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of lowered texts, sorted inside each text, and the text of each."""
    hashes, at = T.words([t.lower() for t in texts])
    grams, text = T.ngrams(hashes, at, SHINGLE)
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < SHINGLE))
    whole = np.array([T.joined(hashes[at[i] : at[i + 1]], at[i + 1] - at[i])[0] for i in short], np.uint64)
    grams, text = np.concatenate((grams, whole)), np.concatenate((text, short))
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], text[new]


def super_minhash(elements: np.ndarray, owner: np.ndarray, n: int, size: int) -> np.ndarray:
    """Signatures (n x size) of n sets: rank j plus a random fraction, the lowest that any element offers to each position."""
    least = np.full(n * size, np.inf)
    places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(elements), 1))
    for j in range(size):
        random = T.mix(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = j + (random >> np.uint64(32)).astype(np.float64) / 2.0**32
        swap = j + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
        row = np.arange(len(elements))
        chosen = places[row, swap].astype(np.int64)
        places[row, swap] = places[row, j]
        np.minimum.at(least, owner * size + chosen, rank)
        going = (least.reshape(n, size).max(1) > j + 1)[owner]
        if not going.any():
            break
        elements, owner, places = elements[going], owner[going], places[going]
    return least.reshape(n, size)


def signed(percent: int):
    size = bands_for(percent) * ROWS

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, known, prints = frame["key"].to_numpy(), frame["known"].to_numpy(), frame["print"].to_numpy()
            for first, texts in T.batches(T.text_column(frame)):
                grams, text = shingles(texts)
                at = np.searchsorted(text, np.arange(len(texts) + 1))
                signature = np.zeros((len(texts), size))
                step = 0
                while step < len(texts):
                    upto = max(step + 1, int(np.searchsorted(at, at[step] + ELEMENTS, "right")) - 1)
                    part = slice(at[step], at[upto])
                    signature[step:upto] = super_minhash(grams[part], text[part] - step, upto - step, size)
                    step = upto
                rows = signature.reshape(len(texts), -1, ROWS)
                bands = [[xxhash.xxh3_64_intdigest(b.tobytes(), seed=k) - (1 << 63) for k, b in enumerate(r)] for r in rows]
                sets = [xxhash.xxh3_128_digest(grams[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
                own = slice(first, first + len(texts))
                yield pd.DataFrame({"key": keys[own], "known": known[own], "print": prints[own], "n_shingles": np.diff(at), "node": sets, "bands": bands})

    return run


class Sets:
    """Shingle sets of some documents, with the exact intersections of one of them and all others."""

    def __init__(self, texts: list[bytes]):
        parts = [(g, t + first) for first, group in T.batches(texts) for g, t in [shingles(group)]]
        values, owner = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        _, number = np.unique(values, return_inverse=True)
        self.size = np.bincount(owner, minlength=len(texts))
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.number, order = number, np.argsort(number, kind="stable")
        self.owners = owner[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(number))))

    def linked(self, i: int, percent: int) -> np.ndarray:
        own = self.number[self.at[i] : self.at[i + 1]]
        start, n = self.first[own], self.first[own + 1] - self.first[own]
        before = np.cumsum(n) - n
        common = np.bincount(self.owners[np.repeat(start - before, n) + np.arange(n.sum())], minlength=len(self.size))
        return np.flatnonzero(100 * common >= percent * (self.size[i] + self.size - common))

    def keep(self, alive: np.ndarray) -> None:
        """From now on only these are found."""
        mask = alive[self.owners]
        self.first = np.concatenate(([0], np.cumsum(mask)))[self.first]
        self.owners = self.owners[mask]

    def groups(self, percent: int) -> np.ndarray:
        """The first member of each one's group of links. A member is compared with those alone that have no group yet, so
        copies of one text are left out as soon as they are found."""
        n = len(self.size)
        group, alive, held = np.full(n, -1), np.ones(n, bool), n
        for start in range(n):
            if not alive[start]:
                continue
            alive[start], group[start], waiting = False, start, [start]
            while waiting:
                found = self.linked(waiting.pop(), percent)
                found = found[alive[found]]
                alive[found], group[found] = False, start
                waiting += found.tolist()
                if 2 * alive.sum() < held:
                    held = int(alive.sum())
                    self.keep(alive)
        return group


def grouped(percent: int):
    """Union-find over the links that the probes of one task have with any of its nodes."""

    def run(family: pd.DataFrame) -> pd.DataFrame:
        family = family.sort_values(["node", "probe"], ascending=[True, False]).drop_duplicates("node", ignore_index=True)
        sets, root = Sets(T.text_column(family)), list(range(len(family)))
        if family["probe"].all():
            return pd.DataFrame({"node": family["node"], "label": family["node"].to_numpy()[sets.groups(percent)]})

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for i in np.flatnonzero(family["probe"]):
            for j in sets.linked(int(i), percent):
                a, b = sorted((find(int(i)), find(int(j))))
                root[b] = a
        return pd.DataFrame({"node": family["node"], "label": [family["node"][find(i)] for i in range(len(family))]})

    return run


def key_columns() -> tuple[Column, Column]:
    """key (what a document is fetched by: its id, or a hash of its text where it has none) and known (it has an id)."""
    doc_id = F.col("doc_id").cast("long")
    return F.coalesce(doc_id, F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).alias("key"), doc_id.isNotNull().alias("known")


def text_print() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("print")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*key_columns(), "text")


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """key, known, print (hash of the text), n_shingles, node (digest of the set) and bands of every row, stored."""
    rows = docs.select(*key_columns(), text_print(), "text")
    return T.written(rows.mapInPandas(signed(percent), "key long, known boolean, print long, n_shingles long, node binary, bands array<long>"), "signatures")


def group_nodes(docs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, label for the nodes that have a candidate; every other node is a group of its own."""
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(F.min_by(F.struct("key", "known", "n_shingles", "bands"), "key").alias("one"))
    banded = nodes.select("node", "one.key", "one.known", "one.n_shingles", F.posexplode("one.bands").alias("band", "value"))
    entries = banded.select("node", "key", "known", "n_shingles", F.xxhash64("band", "value").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = T.written(entries.join(shared, "bucket"), "buckets")
    families = components(buckets).withColumnRenamed("label", "family")
    members = T.written(buckets.select("node", "key", "known", "n_shingles").distinct().join(families, "node"), "families")
    totals = members.groupBy("family").agg(F.count("*").alias("nodes"), F.sum("n_shingles").alias("shingles"))
    small = (F.col("nodes") <= FAMILY) & (F.col("shingles") <= FAMILY_SHINGLES)
    sized = members.join(totals, "family").select("family", "node", "key", "known", small.alias("small"))
    # Always by shuffle: a plan that changes with the number of candidates would not tell how it grows.
    texts = T.written(sized.join(keyed(docs).hint("merge"), ["key", "known"]), "candidates")
    families_small = texts.where("small").withColumn("probe", F.lit(True))
    labelled = T.written(families_small.groupBy("family").applyInPandas(grouped(percent), "node binary, label binary"), "labelled")
    large = T.written(texts.where("not small").select("node", "text").dropDuplicates(["node"]), "large")
    if large.isEmpty():
        return labelled
    entries = T.written(buckets.select("node", "bucket").join(large.select("node"), "node", "left_semi"), "entries")
    return labelled.union(large_groups(large, entries, percent))


def linked_tasks(tasks: DataFrame, texts: DataFrame, percent: int, name: str) -> DataFrame:
    """Links (node, label), one per node and task at most, that probes have with nodes of the same task, by (task, node, probe)."""
    rows = T.written(tasks, f"{name}_tasks").join(texts, "node")
    return T.written(rows.groupBy("task").applyInPandas(grouped(percent), "node binary, label binary").where("node <> label"), name)


def joined_by(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("node").alias("bucket"), F.explode(F.array("node", "label")).alias("node")))


def large_groups(texts: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """node, label of the nodes that are linked inside any bucket of (node, bucket).

    First every node meets its buckets' leaders, which LEADERS hashes choose: work in proportion to the nodes, and enough for copies of one
    text. Then only nodes outside their bucket's largest group so far are compared with all of the bucket.
    """
    stars = star_links(texts, entries, percent)
    labels = T.written(joined_by(stars), "star_labels")
    rest = rest_links(texts, entries, labels, percent)
    return labels if rest.isEmpty() else joined_by(stars.union(rest))


def star_links(texts: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Links of nodes and their buckets' leaders. Buckets with the same leaders are one; its nodes are cut by hash into chunks of about CHUNK
    nodes, and every chunk meets the leaders in a task of its own."""
    chosen = F.array(*[F.min_by("node", F.xxhash64(F.lit(k), "node")) for k in range(LEADERS)])
    leaders = T.written(entries.groupBy("bucket").agg(F.array_sort(F.array_distinct(chosen)).alias("leaders")), "leaders")
    members = T.written(entries.join(leaders, "bucket").select("node", "leaders", F.xxhash64("leaders").alias("star")).distinct(), "star_members")
    chunks = T.written(members.groupBy("star").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.first("leaders").alias("led_by")), "star_chunks")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    own = members.join(chunks, "star").select(F.xxhash64("star", chunk).alias("task"), "node", F.lit(False).alias("probe"))
    each = chunks.select("star", "led_by", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    led = each.select(F.xxhash64("star", "chunk").alias("task"), F.explode("led_by").alias("node"), F.lit(True).alias("probe"))
    return linked_tasks(own.union(led), texts, percent, "star_links")


def rest_links(texts: DataFrame, entries: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links of the nodes outside their bucket's largest group with all of the bucket, chunk by chunk."""
    named = T.written(entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named_entries")
    groups = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = groups.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most"))
    cut = largest.where("most < n").withColumn("rests", F.ceil((F.col("n") - F.col("most")) / CHUNK).cast("int"))
    open_buckets = T.written(cut.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int")), "open_buckets")
    rows = T.written(named.join(open_buckets, "bucket"), "open_entries")
    place = F.xxhash64("node")
    probes = rows.where("label <> largest").select(
        "bucket", "node", F.pmod(place, F.col("rests")).cast("int").alias("rest"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("probe"),
    )
    others = rows.select(
        "bucket", "node", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"),
        F.pmod(place, F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("probe"),
    )
    tasks = probes.unionByName(others).select(F.xxhash64("bucket", "rest", "chunk").alias("task"), "node", "probe")
    return linked_tasks(tasks, texts, percent, "rest_links")


def verdicts(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    rows = signatures(docs, percent)
    doc_id = F.when(F.col("known"), F.col("key"))
    labels = group_nodes(docs, rows, percent)
    named = T.written(rows.drop("bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).withColumn("doc_id", doc_id), "named")
    least = T.written(named.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "least")  # so that a large group's rows can be split
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    found = named.join(least, "label", "left").withColumn("component_id", component)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return verdicts(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each document that stays, with all its columns: the smallest id of every group (without ids the least hash of a text), and
    every document without words."""
    group = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("key").cast("string").cast("binary"))
    kept = verdicts(docs, percent).where("kept").groupBy((F.col("n_shingles") > 0).alias("has_words"), group.alias("group"), "known", "key", "print").agg(F.count("*").alias("copies"))
    one = F.min_by(F.struct("key", "known", "print", "copies"), F.struct("key", "print"))
    found = T.written(kept.groupBy("has_words", "group", "known").agg(one.alias("one")).select("one.*"), "staying")
    names = ["key", "known", "print"]
    rows = T.carried(docs, *key_columns(), text_print()).join(found, names)
    if found.where("copies > 1").isEmpty():
        return T.uncarried(rows, docs)
    return T.uncarried(T.one_each(rows, names, "kept_copies"), docs)
