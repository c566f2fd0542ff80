import pytest
from landed import DAY, NEXT, event, land, land_day

from eventmill.errors import MissingDayError, QualityGateError
from eventmill.operators.gate import GateRules, run_gate, unlisted_keys
from eventmill.schema import RAW_SCHEMA
from eventmill.sources.raw import read_envelopes


def verdicts(result, day=DAY):
    rows = result.checks.where(f"land_date = date'{day}'").collect()
    assert len(rows) == 6
    return {(r["check"], r["column"]): r for r in rows}


def failing(result, day=DAY):
    return {key for key, row in verdicts(result, day).items() if not row.success}


def test_clean_day_passes(spark, scratch):
    land_day(scratch)
    result = run_gate(spark, scratch, [DAY]).enforce()
    assert failing(result) == set()
    assert result.counts[DAY].total == 240 and result.counts[DAY].in_day == 240


def test_day_without_any_org_passes_and_extra_keys_are_allowed(spark, scratch):
    land_day(scratch, surprise=1)
    run_gate(spark, scratch, [DAY]).enforce()
    extra = unlisted_keys(read_envelopes(spark, scratch, [DAY]), RAW_SCHEMA.fieldNames())
    assert [tuple(r) for r in extra.collect()] == [(DAY, "surprise", 240)]


def test_five_percent_of_each_fault_fails_three_checks(spark, scratch):
    def faulty(i, hour):
        fields = {}
        if i % 20 == 0:
            fields["id"] = None
        if i % 20 == 1:
            fields["type"] = f"Odd{i}"
        if i % 20 == 2:
            fields["created_at"] = "2023-06-01T00:00:00Z"
        return event(i, hour=hour, **fields)

    for hour in range(24):
        land(scratch, DAY, hour, [faulty(hour * 20 + n, hour) for n in range(20)])
    result = run_gate(spark, scratch, [DAY])
    assert failing(result) == {("not_null", "id"), ("in_range", "created_at"), ("in_set", "type")}
    row = verdicts(result)["in_set", "type"]
    assert (row.element_count, row.missing_count, row.unexpected_count, row.unexpected_percent) == (480, 0, 24, 5.0)
    by_check = {f["check"]: f for f in result.failures}
    assert len(by_check["in_set"]["partial_unexpected"]) == 20
    assert all(v.startswith("Odd") for v in by_check["in_set"]["partial_unexpected"])
    assert by_check["in_range"]["partial_unexpected"][0] == "2023-06-01 00:00:00"
    assert by_check["not_null"]["partial_unexpected"] == []
    # The message shows some, the values hold them all.
    assert result.values.where("check = 'in_set'").count() == 24
    assert {r.records for r in result.values.where("check = 'in_range'").collect()} == {24}
    with pytest.raises(QualityGateError, match="in_set.*24 of 480, among them Odd"):
        result.enforce()


@pytest.mark.parametrize("column", ["id", "type", "created_at"])
@pytest.mark.parametrize("bad, ok", [(2, True), (3, False)])
def test_exactly_one_percent_of_nulls_passes(spark, scratch, column, bad, ok):
    land(scratch, DAY, 0, [event(i, **({column: None} if i < bad else {})) for i in range(200)])
    assert (("not_null", column) in failing(run_gate(spark, scratch, [DAY]))) is not ok


@pytest.mark.parametrize("bad, ok", [(2, True), (3, False)])
def test_exactly_one_percent_out_of_range_passes(spark, scratch, bad, ok):
    land(scratch, DAY, 0, [event(i, created_at="2024-02-01T00:00:00Z" if i < bad else "2024-01-10T00:00:00Z") for i in range(200)])
    assert (("in_range", "created_at") in failing(run_gate(spark, scratch, [DAY]))) is not ok


@pytest.mark.parametrize(
    "moment, inside",
    [
        ("2024-01-09T18:00:00Z", True),
        ("2024-01-09T17:59:59Z", False),
        ("2024-01-11T06:00:00Z", True),
        ("2024-01-11T06:00:01Z", False),
    ],
)
def test_range_bounds_are_inclusive(spark, scratch, moment, inside):
    land(scratch, DAY, 0, [event(1, created_at=moment)])
    assert (("in_range", "created_at") not in failing(run_gate(spark, scratch, [DAY]))) is inside


def test_nulls_count_against_the_null_rate_only(spark, scratch):
    land(scratch, DAY, 0, [event(i, type=None, created_at="never") for i in range(10)])
    assert failing(run_gate(spark, scratch, [DAY])) == {("not_null", "type"), ("not_null", "created_at")}


def test_missing_column_fails(spark, scratch):
    land_day(scratch, per_hour=2, public=..., repo=...)
    result = run_gate(spark, scratch, [DAY])
    assert failing(result) == {("columns_present", "*")}
    assert verdicts(result)["columns_present", "*"].detail == "repo,public"


def test_a_null_valued_key_is_present(spark, scratch):
    land_day(scratch, per_hour=2, public=None)
    assert failing(run_gate(spark, scratch, [DAY])) == set()


def test_one_late_record_is_enough_for_a_column(spark, scratch, monkeypatch):
    from eventmill.operators import gate

    monkeypatch.setattr(gate, "WITNESSES", 2)
    land(scratch, DAY, 0, [event(i, public=...) for i in range(50)] + [event(50)])
    assert failing(run_gate(spark, scratch, [DAY])) == set()


def test_blank_and_empty_files(spark, scratch):
    land(scratch, DAY, 0, ["", "   "])
    land(scratch, NEXT, 0, [event(1, NEXT)])
    result = run_gate(spark, scratch, [DAY, NEXT])
    assert len(failing(result)) == 6 and failing(result, NEXT) == set()
    assert {r.detail for r in verdicts(result).values()} == {"empty_day"}
    assert result.failed_days == {DAY}


def test_missing_day_and_malformed_line(spark, scratch):
    with pytest.raises(MissingDayError):
        run_gate(spark, scratch, [DAY])
    land(scratch, DAY, 0, [event(1), "{oops"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        run_gate(spark, scratch, [DAY])


def test_days_are_judged_apart(spark, scratch):
    land_day(scratch, DAY, per_hour=2)
    land_day(scratch, NEXT, per_hour=2, start=100, type="Nonsense")
    result = run_gate(spark, scratch, [DAY, NEXT])
    assert failing(result) == set() and failing(result, NEXT) == {("in_set", "type")}


def test_rules_are_parameters(spark, scratch):
    land(scratch, DAY, 0, [event(i, type="Own" if i else None, created_at="2024-01-11T10:00:00Z") for i in range(10)])
    rules = GateRules(known_types=("Own",), tolerated_percent=10, buffer_hours=12)
    assert failing(run_gate(spark, scratch, [DAY], rules)) == set()
