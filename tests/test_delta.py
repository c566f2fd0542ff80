"""States that are kept up by the day, beside the same answer from all of history."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from eventmill.operators import delta_tests, latest, model_tests
from eventmill.sinks import tables

DAYS = [dt.date(2024, 1, d) for d in range(1, 7)]
SCHEMA = "k bigint, v string, created_at timestamp"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark, seed, days=DAYS, keys=30, rows=25):
    rng = random.Random(seed)
    found = [
        (rng.choice([None, *range(keys)]), rng.choice([None, "a", "b", "c"]), dt.datetime(d.year, d.month, d.day, rng.randrange(24), rng.randrange(3)))
        for d in days
        for _ in range(rows)
    ]
    return spark.createDataFrame(found, SCHEMA).withColumn("event_date", F.to_date("created_at"))


def sightings(events):
    return latest.sightings(events.where(F.col("k").isNotNull()), "v", "created_at", "event_date", "k")


def test_latest_follows_added_replaced_and_dropped_days(spark):
    events = made(spark, 1)
    begun = events.where(F.col("event_date") <= DAYS[3])
    state = spark.createDataFrame(latest.newest_per_key(begun, "k", "v", "created_at").collect(), SCHEMA)
    # Day 2 comes again with other rows, day 5 is new, day 1 has left.
    now = events.where(F.col("event_date").between(DAYS[2], DAYS[4]) & (F.col("event_date") != DAYS[2])).unionAll(made(spark, 2, [DAYS[1], DAYS[2]]))
    held = [d for d in DAYS[1:5]]
    found = latest.updated_latest(state, sightings(now), "k", "v", "created_at", [DAYS[1], DAYS[2], DAYS[4]], held)
    assert rows_of(found) == rows_of(latest.newest_per_key(now, "k", "v", "created_at"))
    gone = latest.updated_latest(state, sightings(now.where("false")), "k", "v", "created_at", [], [])
    assert gone.count() == 0


def test_a_new_day_reads_no_other_day_for_the_dimension(spark, prefix):
    tables.ensure_database(spark, f"{prefix}x")
    name = f"{prefix}x.seen"
    tables.put_days(sightings(made(spark, 3)), name, "event_date", ["k"], DAYS, tables.Buckets("k", 4))
    seen = spark.table(name)
    old = made(spark, 3, DAYS[:5])
    tables.replace_table(latest.newest_per_key(old, "k", "v", "created_at"), f"{prefix}x.state", buckets=tables.Buckets("k", 4))
    state = spark.table(f"{prefix}x.state")
    found = latest.updated_latest(state, seen, "k", "v", "created_at", DAYS[5:], DAYS)
    text = plan(found)
    scans = re.findall(r"FileScan parquet .*?(?=\n|$)", text)
    assert len(scans) == 2 and sum("event_date" in s.split("PartitionFilters: ")[1].split("]")[0] for s in scans) == 1
    assert "2024-01-06" in text or "19728" in text
    # The state itself is joined where it lies: every exchange is over the new day's sightings.
    state_branch = text[text.index("state__v") - 2000 : text.index("state__v")]
    assert "Exchange" not in state_branch.split("SortMergeJoin")[-1].split("Window")[0].split("Sort [k")[-1]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_duplicates_and_orphans_by_the_day(spark, seed):
    events = made(spark, seed, keys=60, rows=12)
    index = delta_tests.value_counts(events, "k")
    parent, before = spark.range(0, 60, 2).toDF("id"), spark.range(0, 45).toDF("id")
    dup = orphan = None
    # All but one day, then that day, one again and one gone.
    for due, held, was, is_now in ((DAYS[:5], DAYS[:5], None, before), (DAYS[4:], DAYS[1:], before, parent), ([], DAYS[3:], parent, parent)):
        part = index.where(F.col("event_date").isin(held))
        rows = events.where(F.col("event_date").isin(held))
        dup = delta_tests.updated_duplicates(part, "k", due, dup)
        orphan = delta_tests.updated_orphans(part, "k", due, is_now, "id", was, orphan)
        dup, orphan = (spark.createDataFrame(x.collect(), "k bigint, n bigint") for x in (dup, orphan))
        assert rows_of(dup) == rows_of(model_tests.duplicate_values(rows, "k"))
        assert rows_of(orphan) == rows_of(model_tests.orphan_values(rows, "k", is_now, "id"))


def test_the_index_is_joined_without_a_shuffle(spark, prefix):
    tables.ensure_database(spark, f"{prefix}x")
    name = f"{prefix}x.ids"
    tables.put_days(delta_tests.value_counts(made(spark, 4), "k"), name, "event_date", ["k"], DAYS, tables.Buckets("k", 4))
    index = spark.table(name)
    found = delta_tests.updated_duplicates(index, "k", DAYS[5:])
    text = plan(found)
    assert text.count("Exchange") <= 2 and "Bucketed: true" in text  # both, if any, are over the due day's own values
    below = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in below
    assert rows_of(found.select("k")) == rows_of(model_tests.duplicate_values(made(spark, 4), "k").join(index.where(F.col("event_date") == DAYS[5]), "k", "left_semi").select("k"))
    # A day put again keeps the buckets, and a day without rows leaves.
    tables.put_days(delta_tests.value_counts(made(spark, 5, DAYS[:1]), "k"), name, "event_date", ["k"], DAYS[:2])
    assert tables.partition_days(spark, name) == [DAYS[0], *DAYS[2:]] and tables.buckets_of(spark, name) == tables.Buckets("k", 4)
    assert "Exchange" not in plan(spark.table(name).groupBy("k").agg(F.sum("n")))


def test_day_failures_add_up(spark):
    events = made(spark, 6)
    spec = [model_tests.ColumnTests("m", "k", not_null=True), model_tests.ColumnTests("m", "v", not_null=True, accepted=("a", "b"))]
    found = delta_tests.results_of(spark, spec, [delta_tests.summed_failures(delta_tests.day_failures(events, "event_date", spec))])
    assert rows_of(found) == rows_of(model_tests.run_model_tests({"m": events}, spec))
    nothing = delta_tests.results_of(spark, spec, [delta_tests.summed_failures(delta_tests.day_failures(events.where("false"), "event_date", spec))])
    assert nothing.where("passed").count() == 3


def test_a_reader_between_build_and_swap_sees_the_old_rows(spark, prefix):
    tables.ensure_database(spark, f"{prefix}x")
    name = f"{prefix}x.model"
    tables.replace_table(spark.range(3).toDF("id"), name)
    reader, seen, real = spark.table(name), [], tables.point
    try:
        tables.point = lambda *a: (seen.append(spark.table(name).count()), real(*a))
        tables.replace_table(spark.range(10).toDF("id"), name)
    finally:
        tables.point = real
    assert seen == [3] and spark.table(name).count() == 10 and reader.count() == 3
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.replace_table(spark.range(4).select(F.expr("1 / (id - 2)").alias("id")), name)
    assert spark.table(name).count() == 10
    tables.replace_table(spark.range(5).toDF("id"), name)
    assert len([t for t in spark.catalog.listTables(f"{prefix}x") if "__v" in t.name]) == 2
    tables.forget(spark, name)
    assert not spark.catalog.listTables(f"{prefix}x")


def test_a_day_is_written_once_and_swapped_by_its_location(spark, prefix, monkeypatch):
    import pathlib

    tables.ensure_database(spark, f"{prefix}x")
    name, days = f"{prefix}x.days", DAYS[:3]
    frame = made(spark, 7, days)
    tables.put_days(frame, name, "event_date", ["k"], days)
    root = pathlib.Path(tables._location(spark, tables.physical(spark, name)).removeprefix("file:"))
    other = made(spark, 8, days[:2])
    removed, real = [], tables.remove
    monkeypatch.setattr(tables, "remove", lambda s, folder: (removed.append(folder), real(s, folder)))
    tables.put_days(other, name, "event_date", ["k"], days[:2])
    expected = other.unionAll(frame.where(F.col("event_date") == days[2]))
    assert rows_of(spark.table(name).select(*frame.columns)) == rows_of(expected)
    assert len(removed) == 2 and all("event_date=" in r for r in removed)
    loads = [p for p in root.rglob("*.parquet") if "load-" in str(p)]
    assert {p.parent.name for p in loads} == {f"event_date={d}" for d in days[:2]}
    # A failure after staging leaves the old rows and no files; one while writing too.
    with pytest.raises(OSError), tables.staged(frame, name, "event_date"):
        raise OSError("no")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.put_days(frame.withColumn("k", F.expr("1 div (hour(created_at) - hour(created_at))")), name, "event_date", ["k"], days)
    assert rows_of(spark.table(name).select(*frame.columns)) == rows_of(expected)
    assert {p for p in root.rglob("*.parquet") if "load-" in str(p)} == set(loads)
