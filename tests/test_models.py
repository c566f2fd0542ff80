import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventmill.functions.json_scalar import json_scalars, whole_number
from eventmill.operators.latest import latest_per_key
from eventmill.plans import models, serving
from eventmill.schema import RAW_SCHEMA

SCALARS = {
    "object": ({"b": 1}, None),
    "array": ([1], None),
    "null": (None, None),
    "true": (True, "true"),
    "text": ("opened", "opened"),
    "digits": ("12", "12"),
    "number": (12, "12"),
    "fraction": (12.7, "12.7"),
    "empty": ("", ""),
    "like_object": ("{z}", "{z}"),
    "like_array": ("[1]", "[1]"),
    "like_json": ('{"b":1}', '{"b":1}'),
}


@pytest.mark.parametrize("stored", [False, True])
def test_json_scalars(spark, scratch, stored):
    rows = [(name, json.dumps({"a": value, "n": {"m": value}})) for name, (value, _) in SCALARS.items()]
    rows += [("missing", "{}"), ("unparsable", "{"), ("scalar_parent", '{"n": 3}'), ("no_payload", None)]
    df = spark.createDataFrame(rows, "name string, text string").select("name", F.try_parse_json("text").alias("payload"))
    if stored:
        df.write.parquet(f"{scratch}/p")
        df = spark.read.parquet(f"{scratch}/p")
    got = {r.name: (r.top, r.nested) for r in json_scalars(df, "payload", {"top": "$.a", "nested": "$.n.m"}).collect()}
    assert got == {
        **{name: (want, want) for name, (_, want) in SCALARS.items()},
        **dict.fromkeys(("missing", "unparsable", "scalar_parent", "no_payload"), (None, None)),
    }


def test_whole_number(spark):
    cases = {
        "12": 12, "-3": -3, "+5": 5, " 12 ": 12, "12.7": None, "1.0": None, "": None, "abc": None, "0x1F": None,
        "9223372036854775807": 9223372036854775807, "9223372036854775808": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", whole_number("t").alias("n"))
    assert {r.t: r.n for r in df.collect()} == cases


def raw_frame(spark, records):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return lines.select(F.from_json("value", RAW_SCHEMA, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def record(i, at="2024-01-10T00:00:00Z", kind="PushEvent", actor=1, repo=1, name="r", login="a", **more):
    return {
        "id": None if i is None else str(i), "type": kind, "created_at": at, "public": True, "payload": {},
        "actor": {"id": actor, "login": login}, "repo": None if repo is None else {"id": repo, "name": name}, **more,
    }


def chain(spark, records):
    stg = models.stg_events(raw_frame(spark, records))
    flattened = models.int_events_flattened(stg)
    fact = models.fct_events(flattened)
    return {
        "stg": stg,
        "flat": flattened,
        "fact": fact,
        "dim_repo": models.dim_repo(flattened),
        "dim_actor": models.dim_actor(flattened),
        "agg": models.agg_daily_repo_activity(fact),
    }


def test_staging_keeps_null_types_and_drops_rows_without_id_or_time(spark):
    stg = chain(spark, [record(1), record(None), record(3, at=None), record(4, kind=None, login="", org={"id": 2, "login": ""})])["stg"]
    rows = {r.event_id: r for r in stg.drop("payload").collect()}
    assert set(rows) == {"1", "4"}
    assert rows["4"].event_type is None and rows["4"].actor_login is None and rows["4"].org_login is None
    assert rows["4"].org_id == 2 and rows["1"].org_id is None


def test_payload_fields_do_not_depend_on_the_type(spark):
    payload = {"number": 7, "distinct_size": "3", "issue": {"number": 8}, "ref": "main", "ref_type": "branch", "action": "x"}
    row = chain(spark, [record(1, kind="WatchEvent", payload=payload)])["flat"].first()
    assert (row.pull_request_number, row.push_commit_count, row.issue_number) == (7, 3, 8)
    assert (row.action, row.ref, row.ref_type) == ("x", "main", "branch")


def test_events_without_repo_count_in_the_fact_only(spark):
    records = [record(i, repo=None if i % 3 == 0 else i % 2, name=f"n{i % 2}", kind="ForkEvent") for i in range(30)]
    c = chain(spark, records)
    breakdown = sum(r.event_count for r in serving.event_type_breakdown(c["fact"]).collect())
    total = serving.total_events(c["agg"]).first().total_events
    assert breakdown == 30 and breakdown - total == 10
    assert c["dim_repo"].count() == 2 and serving.repositories_tracked(c["dim_repo"]).first().repo_count == 2


def test_latest_name_wins_even_when_null(spark):
    rows = [
        record(1, "2024-01-10T00:00:00Z", name="old", login="x"),
        record(2, "2024-01-12T00:00:00Z", name="new", login=""),
        record(3, "2024-01-11T00:00:00Z", name="mid", login="y"),
    ]
    c = chain(spark, rows)
    assert [tuple(r) for r in c["dim_repo"].collect()] == [(1, "new")]
    assert [tuple(r) for r in c["dim_actor"].collect()] == [(1, None)]


def test_latest_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = 0 if rng.random() < 0.4 else rng.randrange(200)
        rows.append((key if i % 50 else None, rng.choice(["a", "b", "c", None]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(500))))
    df = spark.createDataFrame(rows, "k bigint, v string, t timestamp").repartition(7)
    best = {}
    for k, v, t in rows:
        if k is not None:
            best[k] = max(best.get(k, (dt.datetime.min, False, "")), (t, v is not None, v or ""))
    want = {k: (v if known else None) for k, (_, known, v) in best.items()}
    assert {r.k: r.v for r in latest_per_key(df, "k", "v", "t").collect()} == want


def test_rollup_against_brute_force_with_a_hot_repo(spark):
    rng = random.Random(5)
    kinds = ["PushEvent", "WatchEvent", "ForkEvent", "PullRequestEvent", "IssuesEvent", "GollumEvent"]
    records = []
    for i in range(1500):
        day = 10 + rng.randrange(3)
        repo = 1 if rng.random() < 0.4 else rng.randrange(40)
        records.append(record(i, f"2024-01-{day}T{rng.randrange(24):02d}:00:00Z", rng.choice(kinds), rng.choice([None, *range(30)]), repo))
    want = {}
    for r in records:
        g = want.setdefault((r["created_at"][:10], r["repo"]["id"]), [0, dict.fromkeys(kinds, 0), set()])
        g[0] += 1
        g[1][r["type"]] += 1
        if r["actor"]["id"] is not None:
            g[2].add(r["actor"]["id"])
    got = chain(spark, records)["agg"].collect()
    assert len(got) == len(want)
    for r in got:
        total, by_kind, actors = want[(str(r.activity_date), r.repo_id)]
        assert (r.total_events, r.distinct_actors) == (total, len(actors))
        assert [r.push_events, r.star_events, r.fork_events, r.pull_request_events, r.issue_events] == [by_kind[k] for k in kinds[:5]]


def test_reports(spark):
    records = [record(i, f"2024-01-1{i % 2}T0{i % 3}:00:00Z", "PullRequestEvent" if i % 4 == 0 else "PushEvent", i % 3, i % 12, f"n{i % 12 % 11}") for i in range(60)]
    c = chain(spark, records)
    top = serving.top_repos(c["agg"], c["dim_repo"]).collect()
    # Repositories 0 and 11 share a name; equal totals are ordered by name.
    assert [tuple(r) for r in top[:3]] == [("n0", 10), ("n1", 5), ("n10", 5)] and len(top) == 10
    assert [r.total_events for r in top] == sorted((r.total_events for r in top), reverse=True)
    assert [r.activity_date.day for r in serving.daily_event_volume(c["agg"]).collect()] == [10, 11]
    assert [(r.hour_of_day, r.event_count) for r in serving.most_active_hours(c["fact"]).collect()] == [(0, 20), (1, 20), (2, 20)]
    assert [(r.event_type, r.event_count) for r in serving.event_type_breakdown(c["fact"]).collect()] == [("PushEvent", 45), ("PullRequestEvent", 15)]
    assert serving.pull_request_activity(c["agg"]).first().pr_events == 15
    assert serving.contributors_tracked(c["dim_actor"]).first().actor_count == 3


def test_reports_over_nothing(spark):
    c = chain(spark, [record(None)])
    assert serving.total_events(c["agg"]).first().total_events is None
    assert serving.repositories_tracked(c["dim_repo"]).first().repo_count == 0


def test_repositories_sharing_a_name_count_together(spark):
    c = chain(spark, [record(i, repo=i, name="same") for i in range(4)])
    assert [tuple(r) for r in serving.top_repos(c["agg"], c["dim_repo"]).collect()] == [("same", 4)]
