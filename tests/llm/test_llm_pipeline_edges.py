"""The pipeline as a whole on rows without ids, repeated rows, columns with clashing names, and an empty table."""

import brute
import corpus_pipeline
import pytest
from test_llm_pipeline import SF_DIR, rows_of

from eventmill.llm import text as T


def all_stages(spark, docs, first=0):
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[first:]:
        frames.append(T.written(stage(spark, frames[-1], SF_DIR), name))
    return frames


def lowered(rows):
    return sorted({(t or "").translate(brute.LOWER) for _, t in rows})


@pytest.mark.parametrize("first", [0, 1])
def test_odd_rows_twice(spark, odd, first):
    """With ``first`` 1 the short texts, which the fixed limits reject, reach the later stages too."""
    frames = all_stages(spark, odd.unionAll(odd), first)
    assert all(f.columns == odd.columns for f in frames[:-1])
    entered, (distinct, apart, mix) = rows_of(frames[1 - first]), map(rows_of, frames[2 - first : 5 - first])
    if not first:
        given = rows_of(frames[0])
        base_failed = [t for _, t in given if brute.quality([(0, t)])[0][6]]
        assert set(entered) <= set(given) and not {t for _, t in entered} & set(base_failed)
    assert set(distinct) <= set(entered) and lowered(distinct) == lowered(entered) and len(distinct) == len(lowered(entered))
    groups = brute.near([(n, t) for n, (_, t) in enumerate(distinct)], corpus_pipeline.NEAR_PERCENT)
    assert set(apart) <= set(distinct) and len(apart) == sum(x[3] for x in groups)
    assert set(mix) <= set(apart) and all(mix.count(row) <= 2 for row in mix)
    packed = frames[-1].collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in mix}
    # Each copy taken is packed once, from its first token on.
    assert sum(r["piece"] == 0 for r in packed) == len(mix)
    assert first == 0 or any(i is None for i, _ in mix)


def test_empty_table(spark, empty):
    frames = all_stages(spark, empty)
    assert all(f.columns == empty.columns for f in frames[:-1])
    assert [f.count() for f in frames] == [0] * len(frames)
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(frames[-1].columns)
