"""Line deduplication beside its plain version."""

import hashlib
from collections import defaultdict

import brute
import pytest

from eventmill.llm import line_dedup

LAST = (1 << 63) - 1


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(brute.LOWER)


def plain(rows, shortest=10, documents=2):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= shortest:
                held[key(line)].add(LAST if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(held[key(x)]) >= documents and min(held[key(x)]) < (LAST if i is None else i) if key(x) in held else False for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("documents", [2, 3])
def test_lines(docs, documents):
    assert rows_of(line_dedup.dedup_lines(docs, documents=documents)) == plain(pairs(docs), documents=documents)


def test_odd_lines(spark, empty):
    shared, menu = "a passage that many hold", "HOME   about us now"
    rows = [
        (3, f"{shared}\nown line of three\n{shared}"), (1, f" \t{shared.upper()} \r\nshort\n\n"), (2, f"{shared}\nshort\n"), (7, shared), (7, shared), (7, f"x\n{shared}\n{menu}"), (None, f"{shared}\n{menu}"),
        (None, f"{menu}\n\n"), (9, "\n\n\n"), (10, ""), (11, None), (12, "ééééééééé\n1234567890"), (13, "ééééééééé\n1234567890"), (14, "éééééééééé\nÉééééééééé"), (15, "éééééééééé"), (16, f"{shared}\x85\n{shared}\x0b"),
        (20, "\n".join(f"line number {i}" for i in range(3000))), (21, "\n".join(f"line number {i}" for i in range(0, 6000, 2))),
    ]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(3)
    assert rows_of(line_dedup.dedup_lines(docs)) == plain(rows * 2)
    assert rows_of(line_dedup.dedup_lines(docs, shortest=1)) == plain(rows * 2, shortest=1)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_one_line_in_all_documents(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('the common line of all\n', id, ' own words here\nthe common line of all') as text")
    found = line_dedup.dedup_lines(rows)
    assert found.where("n_dropped = 2").count() == 2999 and found.where("n_dropped = 0 and doc_id = 0").count() == 1


def test_lines_are_joined_by_shuffle_at_any_size(spark, given):
    plan = line_dedup.dedup_lines(given)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
