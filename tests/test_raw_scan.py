import datetime as dt
import json
import os

import pytest
from landed import DAY, NEXT, event, land
from pyspark.sql import functions as F

from eventmill.plans.load import quarantine
from eventmill.sources import raw


def test_files_without_final_newline_do_not_glue(spark, scratch):
    land(scratch, DAY, 0, [event(0)], newline=False)
    land(scratch, DAY, 1, [event(1, hour=1)], newline=False)
    land(scratch, DAY, 2, [event(2, hour=2)])
    rows = raw.read_events(spark, scratch, [DAY]).collect()
    assert sorted(r.id for r in rows) == ["0", "1", "2"]


def test_typed_nested_read(spark, scratch):
    org = {"id": 9, "login": "o", "gravatar_id": "", "url": "u", "avatar_url": "a"}
    land(scratch, DAY, 5, [event(1, hour=5, org=org), event(2, hour=5, repo=None, extra=1), ""])
    rows = {r.id: r for r in raw.read_events(spark, scratch, [DAY]).withColumn("p", F.to_json("payload")).collect()}
    assert rows["1"].actor.id == 1 and rows["1"].org.login == "o"
    assert rows["2"].org is None and rows["2"].repo is None
    assert json.loads(rows["1"].p) == {"action": "opened", "number": 1}
    assert rows["1"].created_at == dt.datetime(2024, 1, 10, 5, 1)
    assert rows["1"].land_date == DAY


def test_several_days_know_their_day(spark, scratch):
    land(scratch, DAY, 0, [event(1)])
    land(scratch, NEXT, 23, [event(2, NEXT, 23)])
    for read in (raw.read_events, raw.read_light, raw.read_envelopes):
        rows = {r.id: r.land_date for r in read(spark, scratch, [DAY, NEXT]).collect()}
        assert rows == {"1": DAY, "2": NEXT}


def test_an_hour_may_be_a_folder_of_parts(spark, scratch):
    land(scratch, DAY, 0, [event(1)])
    land(scratch, DAY, 1, [event(2, hour=1)])
    day = f"{scratch}/{DAY:%Y/%m/%d}"
    os.makedirs(f"{day}/2.json.gz")
    os.rename(f"{day}/1.json.gz", f"{day}/2.json.gz/part-0.json.gz")
    rows = raw.read_light(spark, scratch, [DAY]).collect()
    assert sorted(r.id for r in rows) == ["1", "2"]


def test_light_scan_coerces_bad_times_to_null(spark, scratch):
    land(scratch, DAY, 0, [event(1, created_at="soon"), event(2, created_at=None), event(3, created_at=...), event(4)])
    rows = {r.id: r.created_at for r in raw.read_light(spark, scratch, [DAY]).collect()}
    assert rows == {"1": None, "2": None, "3": None, "4": dt.datetime(2024, 1, 10, 0, 4)}


def test_light_scan_reads_three_fields(spark, scratch):
    land(scratch, DAY, 0, [event(1)])
    plan = raw.read_light(spark, scratch, [DAY])._jdf.queryExecution().executedPlan().toString()
    fields = ", ".join(f"StructField({c},StringType,true)" for c in ("id", "type", "created_at"))
    assert plan.count("from_json(") == 1 and f"from_json({fields}, (mode" in plan


def test_sample_is_the_first_lines_in_hour_order(spark, scratch):
    for hour in (10, 2, 0):
        land(scratch, DAY, hour, ["", *[event(hour * 100 + n, hour=hour) for n in range(4)], "  "])
    lines = raw.sample_lines(spark, scratch, DAY, 6).collect()
    assert [json.loads(r.value)["id"] for r in lines] == ["0", "1", "2", "3", "200", "201"]
    assert raw.sample_lines(spark, scratch, DAY).count() == 12


def test_sample_stops_at_its_size_and_takes_few_scans(spark, scratch):
    for part in range(40):
        land(scratch, DAY, part % 20, [event(part * 10 + n, hour=part % 20) for n in range(3)], part=part)
    for n, scans in ((2, 1), (3, 1), (5, 2), (119, 6), (500, 6)):
        sample = raw.sample_lines(spark, scratch, DAY, n)
        plan = sample._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == scans and sample.count() == min(n, 120)
    assert [json.loads(r.value)["id"] for r in raw.sample_lines(spark, scratch, DAY, 7).collect()] == ["0", "1", "2", "200", "201", "202", "10"]


def test_malformed_line_fails_fast_or_is_quarantined(spark, scratch):
    land(scratch, DAY, 0, [event(1), '{"id": "2", "type": ', event(3), '{"id":"4","payload":{"a":1,"a":2}}'])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw.read_events(spark, scratch, [DAY]).collect()
    kept = raw.read_events(spark, scratch, [DAY], "PERMISSIVE").cache().where(F.col(raw.CORRUPT).isNull())
    assert sorted(r.id for r in kept.collect()) == ["1", "3"]
    bad = [r.line for r in quarantine(spark, scratch, [DAY]).collect()]
    assert len(bad) == 2 and any(line.startswith('{"id": "2"') for line in bad)


def test_spread_reads_the_same_records(spark, scratch):
    for hour in range(3):
        land(scratch, DAY, hour, [event(n + hour * 50, hour=hour) for n in range(50)])

    def rows(frame):
        return sorted(frame.withColumn("payload", F.to_json("payload")).collect(), key=lambda r: r.id)

    plain = raw.read_events(spark, scratch, [DAY])
    assert rows(raw.read_events(spark, scratch, [DAY], spread=5)) == rows(plain)
    land(scratch, DAY, 3, ["{broken"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw.read_events(spark, scratch, [DAY], spread=5).collect()
    permissive = raw.read_events(spark, scratch, [DAY], "PERMISSIVE", spread=5)
    assert permissive.where(F.col(raw.CORRUPT).isNotNull()).count() == 1


def test_freshness(spark, scratch):
    land(scratch, DAY, 1, [event(5, hour=1), event(7, hour=1)])
    light, now, minute = raw.read_light(spark, scratch, [DAY]), dt.datetime(2024, 1, 10, 2), dt.timedelta(minutes=1)
    row = raw.freshness(light, now).first()
    assert row.max_created_at == dt.datetime(2024, 1, 10, 1, 7)
    assert row.lag_seconds == 53 * 60 and row.status == "pass"
    assert raw.freshness(light, now, 53 * minute, 60 * minute).first().status == "pass"
    assert raw.freshness(light, now, 52 * minute, 60 * minute).first().status == "warn"
    assert raw.freshness(light, now, minute, 52 * minute).first().status == "error"
    assert raw.freshness(light.where("id is null"), now, minute).first().status == "warn"


def test_blank_lines_are_no_records_for_any_reader(spark, scratch):
    land(scratch, DAY, 0, [event(0), "\t", " \t ", "", event(1)])
    readers = [
        raw.read_events(spark, scratch, [DAY]),
        raw.read_events(spark, scratch, [DAY], spread=2),
        raw.read_light(spark, scratch, [DAY]),
        raw.read_envelopes(spark, scratch, [DAY]),
        raw.sample_lines(spark, scratch, DAY),
    ]
    assert [r.count() for r in readers] == [2] * 5


def test_an_array_line_is_malformed_for_every_reader(spark, scratch):
    land(scratch, DAY, 0, [event(0), json.dumps([event(1), event(2)]), "\t", event(3)])
    for spread in (None, 2):
        rows = raw.read_events(spark, scratch, [DAY], "PERMISSIVE", spread).collect()
        assert sorted((r.id or "", r[raw.CORRUPT] is None) for r in rows) == [("", False), ("0", True), ("3", True)]
    for reader in (raw.read_events, raw.read_light, raw.read_envelopes):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            reader(spark, scratch, [DAY]).collect()
        assert reader(spark, scratch, [DAY], "PERMISSIVE").count() == 3
    assert raw.sample_lines(spark, scratch, DAY).count() == 3
