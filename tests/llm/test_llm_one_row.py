"""The pipeline's dedup stages keep exactly one row of a group, also of repeated rows and of groups without ids."""

from eventmill.llm import exact_dedup, near_dedup

SCHEMA = "doc_id long, text string, source string"
TEXT = " ".join(f"word{i}" for i in range(100))
NEAR = TEXT.replace("word99", "other")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_exact_keeps_one_row(spark, prefix):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "A", "y"), (0, "a", "z"), (2, "b", "x"), (None, "c", "x"), (None, "c", "x"), (None, "C", "y"), (None, "b", "x"), (None, None, "x"), (None, "", "x"), (1, "d", "x")]
    docs = spark.createDataFrame(rows * 3, SCHEMA).repartition(4)
    found = rows_of(exact_dedup.distinct(exact_dedup.DigestIndex(spark, f"{prefix}one", buckets=4), docs))
    assert len(found) == 5 and set(found) <= set(rows)
    assert sorted(((i, (t or "").lower()) for i, t, _ in found), key=repr) == sorted([(1, "a"), (2, "b"), (None, "c"), (None, ""), (1, "d")], key=repr)
    marks = exact_dedup.verdicts(exact_dedup.DigestIndex(spark, f"{prefix}marks", buckets=4), docs).where("kept and keep_id = 1").count()
    assert marks == 12


def test_near_keeps_one_row(spark):
    rows = [(None, TEXT, "x"), (None, TEXT, "y"), (None, NEAR, "x"), (None, TEXT + " q", "x"), (7, "one two three four five six", "x"), (7, "one two three four five six", "x"), (9, "one two three four five six", "x"), (None, "", "x"), (None, None, "x"), (4, "", "x"), (4, "", "x"), (5, " ", "x")]
    docs = spark.createDataFrame(rows * 2, SCHEMA).repartition(4)
    found = rows_of(near_dedup.one_of_each(docs))
    assert len(found) == 5 and set(found) <= set(rows)
    assert sum(i is None and (t or "").startswith("word0") for i, t, _ in found) == 1
    assert sorted(i for i, _, _ in found if i is not None) == [4, 5, 7]
    assert rows_of(near_dedup.one_of_each(docs.repartition(3))) == found
    assert near_dedup.near_groups(docs).where("kept and doc_id = 7").count() == 4
