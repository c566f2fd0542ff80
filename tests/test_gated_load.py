"""Gate and load in one pass against the two steps run by themselves."""

import os
from datetime import date

import pytest
from landed import DAY, NEXT, event, land
from pyspark.sql import functions as F

from eventmill.errors import StragglerError
from eventmill.operators import gate
from eventmill.plans import load
from eventmill.plans.load import load_gated
from eventmill.schema import KNOWN_EVENT_TYPES
from eventmill.sinks.tables import REJECTS_SUFFIX, ensure_raw_table
from eventmill.sources import raw

ODD = date(2024, 1, 12)
EMPTY = date(2024, 1, 13)


def records(day, n=200, start=0, **fields):
    return [event(start + i, day, i % 24, type=KNOWN_EVENT_TYPES[i % 3], **fields) for i in range(n)]


def landed(raw_dir, broken=False):
    """A day with a stray, a day with a record without a time, a day of unknown types and an empty one."""
    land(raw_dir, DAY, 0, [*records(DAY), event(900, NEXT, type=KNOWN_EVENT_TYPES[0])])
    land(raw_dir, NEXT, 3, [*records(NEXT, start=300), event(901, NEXT, created_at=None)])
    odd = [event(600 + i, ODD, type=f"Odd{i % 4}") for i in range(30)]
    land(raw_dir, ODD, 5, [*odd, *([event(700, ODD, actor={"id": "text"})] if broken else [])])
    land(raw_dir, EMPTY, 0, ["", "  "])
    return [DAY, NEXT, ODD, EMPTY]


def rows(frame):
    return sorted(map(repr, frame.collect()))


def held(spark, table):
    return [rows(spark.table(name).withColumn("payload", F.to_json("payload"))) for name in (table, table + REJECTS_SUFFIX)]


def files(spark, table):
    root = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location")
    return sorted(os.path.join(f, n) for f, _, names in os.walk(root.removeprefix("file:")) for n in names if n.endswith(".parquet"))


def told(verdict):
    shown = [(f["land_date"], f["check"], f["unexpected_count"], f["detail"], f["partial_unexpected"]) for f in verdict.failures]
    return rows(verdict.checks), sorted(shown), verdict.values and rows(verdict.values), verdict.counts


@pytest.fixture
def both(spark, scratch, prefix, monkeypatch):
    """Runs a load in one pass and in two steps, each into its own table that exists."""

    def run(days, **options):
        results, tables = [], []
        for limit in (31, 0):
            table = f"{prefix}raw.events{limit}"
            ensure_raw_table(spark, table)
            monkeypatch.setattr(load, "OBSERVED_DAYS", limit)
            results.append(load_gated(spark, scratch, days, table, **options))
            tables.append(table)
        return results, tables

    return run


@pytest.mark.parametrize("mode", ["FAILFAST", "PERMISSIVE"])
def test_one_pass_gives_what_two_steps_give(spark, scratch, both, mode):
    days = landed(scratch)
    if mode == "PERMISSIVE":
        land(scratch, DAY, 7, ["{oops", "[1]", event(902, type=KNOWN_EVENT_TYPES[0], repo={"id": "text"})])
    ((one, loaded), (two, expected)), (table, other) = both(days, mode=mode, strict=False)
    assert told(one) == told(two) and one.failed_days == {ODD, EMPTY}
    assert loaded == expected and loaded.loaded[DAY] == 200 and loaded.rejected == {DAY: 1}
    assert held(spark, table) == held(spark, other)


def test_one_scan_of_the_text(spark, scratch, raw_table, monkeypatch):
    days = landed(scratch)[:2]
    ensure_raw_table(spark, raw_table)
    asked = []
    lines = raw._lines
    monkeypatch.setattr(raw, "_lines", lambda *a: asked.append(a[2]) or lines(*a))
    verdict, loaded = load_gated(spark, scratch, days, raw_table, strict=False)
    assert asked == [days] and verdict.failures == [] and loaded.rows_written == 401
    # Files that are not small are written by the tasks that read them.
    monkeypatch.setattr(load, "SHARED_TASK_FILE_BYTES", 0)
    assert load_gated(spark, scratch, days, raw_table, strict=False)[1] == loaded


def test_rows_of_failed_days_leave_no_files(spark, scratch, raw_table):
    days = landed(scratch)
    ensure_raw_table(spark, raw_table)
    assert load_gated(spark, scratch, [ODD], raw_table)[1] is None
    assert files(spark, raw_table) == []
    load_gated(spark, scratch, days, raw_table, strict=False)
    before, kept = held(spark, raw_table), files(spark, raw_table)
    assert not [f for f in kept if f"event_date={ODD}" in f]
    # A strict load refuses the stray, and everything stays as it was.
    with pytest.raises(StragglerError):
        load_gated(spark, scratch, days, raw_table)
    assert held(spark, raw_table) == before and files(spark, raw_table) == kept


def test_malformed_lines_stop_where_the_two_steps_stop(spark, scratch, raw_table):
    days = landed(scratch, broken=True)
    ensure_raw_table(spark, raw_table)
    verdicts = []
    # A record of another shape on a day that fails is set aside with its day.
    _, loaded = load_gated(spark, scratch, days, raw_table, strict=False, judged=verdicts.append)
    assert verdicts[0].failed_days == {ODD, EMPTY} and loaded.loaded == {DAY: 200, NEXT: 201}
    before = held(spark, raw_table)
    for line in (event(903, repo={"id": "text"}), "{oops"):
        land(scratch, DAY, 9, [line])
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            load_gated(spark, scratch, days, raw_table, strict=False)
        assert held(spark, raw_table) == before


def test_a_late_key_is_found(spark, scratch, raw_table, monkeypatch):
    monkeypatch.setattr(gate, "WITNESSES", 2)
    land(scratch, DAY, 0, [*records(DAY, public=...), event(999, type=KNOWN_EVENT_TYPES[0])])
    ensure_raw_table(spark, raw_table)
    verdict, loaded = load_gated(spark, scratch, [DAY], raw_table)
    assert verdict.failures == [] and loaded.loaded == {DAY: 201}
