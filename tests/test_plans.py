"""The physical plans the design relies on."""

import re

import pytest
from landed import DAY, land_day
from pyspark.sql import functions as F

from eventmill.operators import gate, model_tests
from eventmill.plans import models, serving
from eventmill.plans.load import load_days
from eventmill.sources import raw
from harness import queries

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    raw_dir = str(tmp_path_factory.mktemp("landed"))
    land_day(raw_dir, per_hour=3)
    load_days(spark, raw_dir, [DAY], "plans_raw.events")
    return spark.table("plans_raw.events")


@pytest.fixture(scope="module")
def flattened(stored):
    return models.int_events_flattened(models.stg_events(stored))


def test_rollup_reads_four_columns_and_aggregates_before_the_shuffle(flattened):
    text = plan(models.agg_daily_repo_activity(models.fct_events(flattened)))
    assert "payload" not in text
    assert "actor:struct<id:bigint>" in text and "repo:struct<id:bigint>" in text
    assert "PushedFilters: [IsNotNull(id), IsNotNull(created_at)" in text
    assert "SortAggregate" not in text and "partial_count" in text


def test_flattening_reads_shredded_payload_fields(flattened):
    text = plan(flattened)
    assert re.search(r"payload#\d+\.5 AS issue_number_value", text)
    assert "Exchange" not in text


def test_latest_per_key_never_sorts_rows(flattened):
    text = plan(models.dim_repo(flattened))
    below_exchange = text[text.rindex("Exchange") :]
    assert "SortAggregate" not in text and "Sort [" not in below_exchange
    assert "HashAggregate" in below_exchange and "WindowGroupLimit" in text
    assert "payload" not in text and "actor" not in text


def test_top_repos_needs_no_total_sort(flattened):
    rollup = models.agg_daily_repo_activity(models.fct_events(flattened))
    text = plan(serving.top_repos(rollup, models.dim_repo(flattened)))
    assert "TakeOrderedAndProject" in text


def test_gate_is_one_hash_aggregate_over_one_scan(spark, tmp_path):
    land_day(str(tmp_path), per_hour=2)
    text = plan(gate.day_counts(raw.read_envelopes(spark, str(tmp_path), [DAY], witnesses=10)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_reading_events_does_not_shuffle(spark, tmp_path):
    land_day(str(tmp_path), per_hour=2)
    events = raw.read_events(spark, str(tmp_path), [DAY])
    assert "Exchange" not in plan(events.sortWithinPartitions("type"))


def test_orphan_check_combines_child_rows_before_the_join(flattened):
    orphans = model_tests.orphan_values(models.fct_events(flattened), "repo_id", models.dim_repo(flattened), "repo_id")
    text = plan(orphans)
    assert "LeftAnti" in text
    assert text.index("LeftAnti") < text.index("HashAggregate")


@pytest.mark.parametrize(
    "name", ["top_repos", "repo_totals", "sync_plan", "model_tests", "test_relationships", "gate_faulty_days", "dim_actor"]
)
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_python_in_any_plan(spark):
    for name in ("stg_events", "fct_events", "top_repos", "model_tests", "gate_faulty_days"):
        assert "Python" not in plan(queries.QUERIES[name](spark, SF_DIR).where(F.lit(True)))
