"""What a batch costs the digest index: one read of the index, and no job for making it."""

from eventmill.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def test_a_batch_joins_the_index_once(spark, prefix, monkeypatch):
    own = exact_dedup.DigestIndex(spark, f"{prefix}once", buckets=4)
    own.add(spark.createDataFrame([(1, "A"), (2, "b"), (None, "n")], SCHEMA))
    plans, written = [], exact_dedup.T.written

    def noted(frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return written(frame, name)

    monkeypatch.setattr(exact_dedup.T, "written", noted)
    rows, classes = own.add(spark.createDataFrame([(7, "a"), (8, "N"), (8, "n"), (None, "c"), (9, None)], SCHEMA))
    assert sum(own.table in plan for plan in plans) == 1
    kept = {r["digest"]: (r["keep_id"], r["group_size"]) for r in classes.collect()}
    found = {(r["doc_id"], *kept[r["digest"]]) for r in rows.collect()}
    assert found == {(7, 1, 1), (8, None, 2), (None, None, 1), (9, 9, 1)} and len(kept) == 4
    assert own.read().count() == 5 == own.read().select("digest").distinct().count()


def test_an_index_is_made_without_a_job(spark, prefix):
    spark.sparkContext.setJobGroup(f"{prefix}made", "making an index")
    try:
        exact_dedup.DigestIndex(spark, f"{prefix}made", buckets=4).create(5)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"{prefix}made")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
