"""Line deduplication: explode normalised lines, hash, count documents per hash, drop what too many hold, reassemble by position.

A text is split at line feeds; a line's key is the line without white space at its ends, A-Z lowered. A key of at least SHORTEST code points
that DOCUMENTS documents hold loses all its lines, except in the document with the smallest id that holds it, where all of them stay.

Lines travel as two 64-bit hashes, a document number and a position; the texts are shuffled once, to meet the positions that go. A line that
every document holds is one group of a count, and a join that adaptive execution splits. Positions are combined per task, so a
row that repeats often costs one set of positions.

A null or empty text is one empty line. A null id counts as larger than any other, and rows that share an id (null included) are
one document: they never remove each other's lines, and each is answered by itself. Empty tables give no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T

SHORTEST, DOCUMENTS = 10, 2
SPACE = " \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return T.lower_ascii(F.btrim(line, F.lit(SPACE)))


def named(docs: DataFrame) -> DataFrame:
    """doc_id, doc (its number, one for all rows without an id), print (hash of the text) and text."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("print"), text.alias("text"))


def split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_lines(rows: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc, print, place and 128-bit hash of every line whose key is long enough."""
    lines = rows.select("doc", "print", F.posexplode(split(F.col("text"))).alias("place", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= shortest)
    return keyed.select("doc", "print", "place", F.xxhash64("key").alias("hash"), F.xxhash64(F.lit(1), "key").alias("more"))


def shared_lines(lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """hash, more and least (the document that keeps it) of the lines that so many documents hold."""
    counts = lines.groupBy("hash", "more").agg(F.count_distinct("doc").alias("documents"), F.min("doc").alias("least"))
    return counts.where(F.col("documents") >= documents).drop("documents")


def reassembled(lines: Column, gone: Column) -> Column:
    """The lines at all other positions, joined. Both go in as one struct, so that the lines are split once, not once per position."""
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    both = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    return F.transform(both, lambda x: F.array_join(F.transform(x["left"], lambda i: F.get(x["lines"], i)), "\n"))[0]


def dedup_lines(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that is left) and kept_sha256 of every row."""
    rows = named(docs)
    lines = hashed_lines(rows, shortest)
    # Joined by shuffle at any size, as the number of shared lines has no bound.
    shared = T.written(shared_lines(lines, documents), "shared_lines").hint("merge")
    places = lines.join(shared, ["hash", "more"]).where("doc > least").groupBy("doc", "print").agg(F.collect_set("place").alias("gone"))
    found = rows.join(T.written(places, "places").hint("merge"), ["doc", "print"], "left")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(reassembled(split(F.col("text")), F.col("gone")))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    answered = found.select("doc_id", n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
    return answered.withColumn("kept_sha256", F.sha2("kept", 256))
