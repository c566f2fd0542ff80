import datetime as dt

import pytest
from landed import DAY, NEXT, event, land, land_day

from eventmill.errors import LoadMismatchError, StragglerError
from eventmill.plans.load import load_days
from eventmill.sinks import tables
from eventmill.sources.raw import within_days


def per_day(spark, table):
    return {r.event_date: r["count"] for r in spark.table(table).groupBy("event_date").count().collect()}


def test_reload_replaces_one_day_only(spark, scratch, raw_table):
    land_day(scratch, DAY)
    land_day(scratch, NEXT, start=1000)
    first = load_days(spark, scratch, [DAY, NEXT], raw_table)
    assert first.rows_written == 480 and first.loaded == {DAY: 240, NEXT: 240}
    again = load_days(spark, scratch, [DAY], raw_table)
    assert again.rows_written == 240
    assert per_day(spark, raw_table) == {DAY: 240, NEXT: 240}
    land(scratch, DAY, 0, [event(5)])
    load_days(spark, scratch, [DAY], raw_table)
    assert per_day(spark, raw_table) == {DAY: 231, NEXT: 240}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_one_early_event_must_not_replace_the_next_day(spark, scratch, raw_table):
    land_day(scratch, NEXT, start=1000)
    load_days(spark, scratch, [NEXT], raw_table)
    land_day(scratch, DAY)
    land(scratch, DAY, 23, [event(1), event(7, NEXT), event(8, created_at=None)])
    with pytest.raises(StragglerError, match="2024-01-10: 1"):
        load_days(spark, scratch, [DAY], raw_table)
    assert per_day(spark, raw_table) == {NEXT: 240}
    result = load_days(spark, scratch, [DAY], raw_table, strict=False)
    assert result.rejected == {DAY: 1} and result.rows_written == 232
    assert per_day(spark, raw_table) == {DAY: 232, NEXT: 240}
    rejects = spark.table(raw_table + "_rejects")
    assert [(r.id, r.event_date) for r in rejects.collect()] == [("7", DAY)]
    # A clean reload takes the rejects back.
    land(scratch, DAY, 23, [event(1)])
    load_days(spark, scratch, [DAY], raw_table)
    assert spark.table(raw_table + "_rejects").count() == 0


def test_day_left_with_no_row_is_emptied(spark, scratch, raw_table):
    land(scratch, DAY, 0, [event(1)])
    load_days(spark, scratch, [DAY], raw_table)
    land(scratch, DAY, 0, [event(1, NEXT)])
    load_days(spark, scratch, [DAY], raw_table, strict=False)
    assert per_day(spark, raw_table) == {}


def test_permissive_load_leaves_malformed_lines_out(spark, scratch, raw_table):
    land(scratch, DAY, 0, [event(1), "{oops", event(2)])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_days(spark, scratch, [DAY], raw_table)
    result = load_days(spark, scratch, [DAY], raw_table, mode="PERMISSIVE")
    assert result.rows_written == 2 and result.loaded == {DAY: 2} and result.rejected == {}
    assert per_day(spark, raw_table) == {DAY: 2}
    land(scratch, DAY, 0, ["{oops", '{"id":"4","payload":{"a":1,"a":2}}', event(5, NEXT)])
    result = load_days(spark, scratch, [DAY], raw_table, strict=False, mode="PERMISSIVE")
    assert result.loaded == {} and result.rejected == {DAY: 1}
    assert per_day(spark, raw_table) == {}


def test_a_record_the_count_and_the_load_disagree_on_is_not_lost_silently(spark, scratch, raw_table):
    land(scratch, DAY, 0, [event(1), event(2, created_at=12)])
    with pytest.raises(LoadMismatchError, match="counted 2 records"):
        load_days(spark, scratch, [DAY], raw_table)


def test_a_load_that_fails_leaves_the_old_rows(spark, scratch, raw_table, monkeypatch):
    from eventmill.plans import load

    land_day(scratch, DAY)
    load_days(spark, scratch, [DAY], raw_table)
    old = sorted(r.id for r in spark.table(raw_table).collect())
    # A count the parse does not confirm.
    land(scratch, DAY, 0, [event(1), event(2, created_at=12)])
    with pytest.raises(LoadMismatchError):
        load_days(spark, scratch, [DAY], raw_table, strict=False)
    # A line that only the full parse refuses, while rows are being written.
    land(scratch, DAY, 0, [event(1), event(2, public="maybe")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_days(spark, scratch, [DAY], raw_table)

    def broken(*args, **kwargs):
        raise OSError("disk full")

    land(scratch, DAY, 0, ["{oops", event(1)])
    monkeypatch.setattr(load, "replace_days", broken)
    for mode in ("PERMISSIVE",):
        with pytest.raises(OSError):
            load_days(spark, scratch, [DAY], raw_table, mode=mode)
    assert sorted(r.id for r in spark.table(raw_table).collect()) == old
    # Nothing half-done is left beside the table either.
    assert not [t.name for t in spark.catalog.listTables(raw_table.split(".")[0]) if "staged" in t.name]


def test_an_empty_dynamic_overwrite_mode_is_never_set_in_the_callers_session(spark, scratch, raw_table, monkeypatch):
    from eventmill.plans import load

    land_day(scratch, DAY)
    seen, real = [], load.replace_days
    monkeypatch.setattr(load, "replace_days", lambda *a, **k: (real(*a, **k), seen.append(spark.conf.get("spark.sql.sources.partitionOverwriteMode"))))
    load_days(spark, scratch, [DAY], raw_table)
    assert [mode.upper() for mode in seen] == ["STATIC", "STATIC"]


def test_oversized_files_are_dealt_out(spark, scratch, raw_table, monkeypatch):
    from eventmill.plans import load

    land_day(scratch, DAY)
    land_day(scratch, NEXT, start=1000)
    monkeypatch.setattr(load, "OVERSIZED_FILE_BYTES", 10)
    monkeypatch.setattr(load, "SPREAD_BYTES", 1000)
    assert load_days(spark, scratch, [DAY, NEXT], raw_table).rows_written == 480
    assert per_day(spark, raw_table) == {DAY: 240, NEXT: 240}


def test_rows_are_clustered_by_type(spark, scratch, raw_table):
    land_day(scratch)
    load_days(spark, scratch, [DAY], raw_table)
    for file in spark.table(raw_table).inputFiles():
        types = [r.type for r in spark.read.parquet(file).collect()]
        assert types == sorted(types)


def test_retention(spark, scratch, raw_table):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for n, day in enumerate(days):
        land(scratch, day, 0, [event(n, day)])
    load_days(spark, scratch, days, raw_table)
    assert tables.expire_days(spark, raw_table, dt.date(2024, 3, 2)) == days[:1]
    assert sorted(per_day(spark, raw_table)) == days[1:]
    assert tables.expire_days(spark, raw_table, dt.date(2024, 3, 2)) == []
    assert tables.expire_days(spark, raw_table, dt.date(2024, 1, 4), keep_days=1) == [days[1]]
    assert tables.partition_days(spark, raw_table) == days[2:]
    assert tables.partition_days(spark, "no_such.table") == []


def test_range_filter_prunes_partitions(spark, scratch, raw_table):
    land_day(scratch, DAY)
    land_day(scratch, NEXT, start=1000)
    load_days(spark, scratch, [DAY, NEXT], raw_table)
    part = within_days(spark.table(raw_table), DAY, NEXT)
    assert part.count() == 240
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_materialization_follows_the_target(spark, prefix):
    df = spark.createDataFrame([(1, "a")], "repo_id bigint, repo_name string")
    tables.materialize("dim_repo", df, "dev", prefix=prefix)
    assert not spark.catalog.databaseExists(f"{prefix}dev_marts")
    tables.materialize("dim_repo", df.union(df), "prod", prefix=prefix)
    assert spark.table(f"{prefix}prod_marts.dim_repo").count() == 2
    assert tables.read_model(spark, "dev", "dim_repo", prefix).count() == 1
    assert tables.read_model(spark, "prod", "dim_repo", prefix).count() == 2
    tables.materialize("dim_repo", df, "prod", prefix=prefix)
    assert tables.read_model(spark, "prod", "dim_repo", prefix).count() == 1
    # Staging stays a view on prod; a model's own choice beats the default.
    assert tables.materialization("prod", "stg_events") == "view"
    assert tables.materialization("dev", "fct_events", "table") == "table"
