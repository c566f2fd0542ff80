import datetime as dt
import os

import pytest
from landed import DAY, NEXT, event, land, land_day

from eventmill.errors import MissingDayError, ModelTestError, QualityGateError
from eventmill.operators.model_tests import ColumnTests, run_model_tests
from eventmill.plans import pipeline
from eventmill.plans.load import load_days
from eventmill.sinks import tables

THIRD = dt.date(2024, 1, 12)
MARTS = ("fct_events", "dim_repo", "dim_actor", "agg_daily_repo_activity")


def content(built):
    return {m: sorted(tuple(r) for r in built[m].select(*sorted(built[m].columns)).collect()) if m != "fct_events"
            else sorted(built[m].collect(), key=lambda r: int(r.event_id)) for m in MARTS}


@pytest.mark.parametrize("target", ["dev", "prod"])
def test_daily_run(spark, scratch, raw_table, prefix, target):
    land_day(scratch)
    result = pipeline.run_day(spark, scratch, DAY, raw_table=raw_table, target=target, prefix=prefix)
    assert result.load.loaded == {DAY: 240}
    assert result.tests.count() == 15 and result.tests.where("not passed").count() == 0
    assert result.models["fct_events"].count() == 240
    assert result.models["fct_events"].columns == list(pipeline.models.FACT_COLUMNS)
    assert spark.catalog.databaseExists(f"{prefix}prod_marts") is (target == "prod")


def test_day_refresh_equals_full_build(spark, scratch, raw_table, prefix):
    land_day(scratch, DAY, repo={"id": 1, "name": "old"})
    land_day(scratch, NEXT, start=1000)
    land_day(scratch, THIRD, start=2000, repo={"id": 1, "name": "new"})
    options = {"raw_table": raw_table, "target": "prod", "prefix": prefix}
    pipeline.run_days(spark, scratch, [DAY, THIRD], **options)
    # A late back-fill between two loaded days, then one day once more with fewer rows.
    pipeline.run_day(spark, scratch, NEXT, **options)
    land(scratch, THIRD, 5, [])
    by_day = content(pipeline.run_day(spark, scratch, THIRD, **options).models)
    full = content(pipeline.run_day(spark, scratch, THIRD, refresh="full", **options).models)
    assert by_day == full
    assert ("new" in str(by_day["dim_repo"])) and len(by_day["fct_events"]) == 710
    views = content(pipeline.build_models(spark, spark.table(raw_table), "dev", prefix))
    assert views == full
    assert content(pipeline.refresh_models(spark, raw_table, [NEXT], prefix=prefix)) == full


def test_days_that_leave_the_raw_table_leave_the_marts(spark, scratch, raw_table, prefix):
    land_day(scratch, DAY)
    land_day(scratch, NEXT, start=1000, repo={"id": 77, "name": "later"})
    load_days(spark, scratch, [DAY, NEXT], raw_table)
    pipeline.refresh_models(spark, raw_table, prefix=prefix)
    tables.expire_days(spark, raw_table, NEXT, keep_days=0)
    left = pipeline.refresh_models(spark, raw_table, prefix=prefix)
    assert left["fct_events"].count() == 240
    assert [r.repo_id for r in left["dim_repo"].collect()] == [77]


def test_a_reload_that_never_reached_the_marts_is_made_up_for(spark, scratch, raw_table, prefix):
    for n, day in enumerate((DAY, NEXT, THIRD)):
        land_day(scratch, day, start=1000 * n, repo={"id": n, "name": f"r{n}"})
    options = {"raw_table": raw_table, "target": "prod", "prefix": prefix}
    pipeline.run_days(spark, scratch, [DAY, NEXT], **options)
    # The first day loses records; its run dies before the models.
    land(scratch, DAY, 3, [])
    load_days(spark, scratch, [DAY], raw_table)
    by_day = content(pipeline.run_day(spark, scratch, THIRD, **options).models)
    assert len(by_day["fct_events"]) == 710
    assert by_day == content(pipeline.rebuild_models(spark, raw_table, prefix=prefix))
    # Nothing is due once all is settled.
    before = spark.table(f"{prefix}prod_marts.mart_builds").count()
    pipeline.refresh_models(spark, raw_table, prefix=prefix)
    again = spark.table(f"{prefix}prod_marts.mart_builds").count()
    pipeline.refresh_models(spark, raw_table, prefix=prefix)
    assert spark.table(f"{prefix}prod_marts.mart_builds").count() == again >= before


def test_failed_gate_stops_before_the_load(spark, scratch, raw_table, prefix):
    land_day(scratch, type="Nonsense")
    with pytest.raises(QualityGateError):
        pipeline.run_day(spark, scratch, DAY, raw_table=raw_table, prefix=prefix)
    assert not spark.catalog.tableExists(raw_table)


def test_back_fill_loads_the_good_days_and_reports_the_bad(spark, scratch, raw_table, prefix):
    land_day(scratch, DAY)
    land_day(scratch, NEXT, start=1000, type="Nonsense")
    with pytest.raises(QualityGateError, match="2024-01-11"):
        pipeline.run_days(spark, scratch, [DAY, NEXT], raw_table=raw_table, target="prod", prefix=prefix)
    assert tables.partition_days(spark, raw_table) == [DAY]
    assert tables.read_model(spark, "prod", "fct_events", prefix).count() == 240


def test_days_that_did_not_land_are_set_aside(spark, scratch, raw_table, prefix):
    land_day(scratch, DAY)
    land_day(scratch, THIRD, start=2000)
    owed = [(dt.datetime(2024, 1, day, hour), True, None) for day in (10, 12) for hour in range(24)]
    os.remove(f"{scratch}/2024/01/12/7.json.gz")
    manifest = spark.createDataFrame(owed, "hour timestamp, exists boolean, content_length bigint")
    options = {"raw_table": raw_table, "prefix": prefix}
    with pytest.raises(MissingDayError, match="2024-01-11") as raised:
        pipeline.run_days(spark, scratch, [DAY, NEXT, THIRD], manifest=manifest, **options)
    rows = {r.land_date: (r.coverage, r.gate, r.loaded, r.stopped_by) for r in raised.value.outcome.collect()}
    assert rows == {
        DAY: ("complete", "passed", 240, None),
        NEXT: ("missing", None, None, "coverage"),
        THIRD: ("incomplete", None, None, "coverage"),
    }
    assert "SyncFailedError" in raised.value.__notes__[0]
    assert tables.partition_days(spark, raw_table) == [DAY]
    nothing = pipeline.run_days(spark, scratch, [NEXT], enforce=False, **options)
    assert nothing.load is None and nothing.outcome.first().stopped_by == "coverage"


def test_offending_values_are_kept_and_old_days_expire(spark, scratch, raw_table, prefix):
    land(scratch, DAY, 0, [event(1)])
    land(scratch, NEXT, 0, [event(n, NEXT, type=f"Odd{n}") for n in range(30)])
    options = {"raw_table": raw_table, "prefix": prefix, "enforce": False}
    land(scratch, THIRD, 0, [event(50, THIRD)])
    run = pipeline.run_days(spark, scratch, [DAY, NEXT, THIRD], keep_days=1, **options)
    kept = spark.table(raw_table + tables.OFFENDERS_SUFFIX)
    assert kept.count() == 30 and {r.land_date for r in kept.collect()} == {NEXT}
    assert tables.partition_days(spark, raw_table) == [THIRD]
    assert [(r.expired, r.stopped_by) for r in run.outcome.orderBy("land_date").collect()] == [(True, None), (False, "gate"), (False, None)]


def test_duplicate_ids_are_reported_and_kept(spark, scratch, raw_table, prefix):
    land(scratch, DAY, 0, [event(1), event(2), event(2)])
    with pytest.raises(ModelTestError, match="stg_events.event_id unique: 1; fct_events.event_id unique: 1"):
        pipeline.run_day(spark, scratch, DAY, raw_table=raw_table, target="prod", prefix=prefix)
    assert tables.read_model(spark, "prod", "fct_events", prefix).count() == 3


def test_null_type_within_the_gate_fails_the_model_test(spark, scratch, raw_table, prefix):
    land(scratch, DAY, 0, [event(i, type=None if i == 7 else "PushEvent") for i in range(100)])
    with pytest.raises(ModelTestError, match="^stg_events.event_type not_null: 1$"):
        pipeline.run_day(spark, scratch, DAY, raw_table=raw_table, prefix=prefix)


def test_model_tests_count_failures(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z"), (9, "z"), (9, "z")], "k bigint, v string")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k bigint")
    specs = [
        ColumnTests("child", "k", unique=True, not_null=True, parent=("parent", "k")),
        ColumnTests("child", "v", not_null=True, accepted=("a", "b")),
        ColumnTests("parent", "k", unique=True),
    ]
    rows = {(r.model, r.column, r.test): r.failures for r in run_model_tests({"child": child, "parent": parent}, specs).collect()}
    assert rows == {
        ("child", "k", "unique"): 2,
        ("child", "k", "not_null"): 1,
        ("child", "k", "relationships"): 2,
        ("child", "v", "not_null"): 1,
        ("child", "v", "accepted_values"): 1,
        ("parent", "k", "unique"): 1,
    }


def test_model_tests_over_nothing_pass(spark):
    empty = spark.createDataFrame([], "k bigint, v string")
    specs = [ColumnTests("m", "k", unique=True, not_null=True, parent=("m", "k")), ColumnTests("m", "v", not_null=True)]
    assert run_model_tests({"m": empty}, specs).where("passed").count() == 4
