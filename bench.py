"""Times the headline queries and prints one JSON line.

Two parts: the models and reports over the given ``events`` table, and the daily run (gate, load, marts,
tests, reports) over one landed day of a real feed's size: the given events replicated to about 2.5
million records of about one kilobyte in 24 hourly files.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from eventmill.operators.gate import run_gate  # noqa: E402
from eventmill.operators.model_tests import run_model_tests  # noqa: E402
from eventmill.plans import pipeline, serving  # noqa: E402
from eventmill.plans.load import DayRows, load_days, load_gated  # noqa: E402
from eventmill.session import build_session  # noqa: E402
from harness import feed  # noqa: E402
from harness.queries import registry  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY_EVENTS = int(os.environ.get("BENCH_DAY_EVENTS", "2500000"))
DAY = dt.date(2024, 1, 1)

HEADLINE = (
    "stg_events",
    "int_events_flattened",
    "dim_repo",
    "dim_actor",
    "fct_events",
    "agg_daily_repo_activity",
    "daily_event_volume",
    "top_repos",
    "most_active_hours",
    "event_type_breakdown",
    "total_events_tracked",
    "repositories_tracked",
    "contributors_tracked",
    "pull_request_activity",
    "gate_faulty_days",
    "model_tests",
    "sync_plan",
    "test_unique",
    "test_relationships",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def land_day(spark, raw_dir: str) -> int:
    """One day in 24 gzip files, 24 tasks."""
    base = feed.raw_events(spark, SF_DIR)
    copies = max(1, round(DAY_EVENTS / base.count()))
    clock = F.date_format("created_at", "HH:mm:ss.SSSSSS")
    copied = base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    body = F.repeat(F.md5(F.concat("id", F.col("copy").cast("string"))), 20)
    records = copied.select(
        F.concat("id", F.lit("-"), F.col("copy").cast("string")).alias("id"),
        "type",
        "actor",
        "repo",
        "org",
        F.parse_json(F.concat(F.lit('{"body":"'), body, F.lit('",'), F.substr(F.to_json("payload"), F.lit(2)))).alias("payload"),
        "public",
        F.concat(F.lit(f"{DAY}T"), clock, F.lit("Z")).alias("created_at"),
        F.hour("created_at").alias("hour"),
    )
    staged = f"{raw_dir}-staged"
    records.repartition(24, "hour").write.partitionBy("hour").option("compression", "gzip").json(staged)
    for hour in range(24):
        folder = f"{staged}/hour={hour}"
        target = f"{raw_dir}/{DAY:%Y/%m/%d}/{hour}.json.gz"
        os.makedirs(target, exist_ok=True)
        for name in os.listdir(folder):
            os.rename(f"{folder}/{name}", f"{target}/{name}")
    return copies


def main() -> None:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    queries = registry()
    run(queries["stg_events"](spark, SF_DIR))  # starts the JVM's code paths
    for name in HEADLINE:
        timed(name, lambda: run(queries[name](spark, SF_DIR)))

    raw_dir = f"{root}/raw"
    land_day(spark, raw_dir)
    gate = timed("day_gate", lambda: run_gate(spark, raw_dir, [DAY]))
    events = gate.counts[DAY].total
    counted = {DAY: DayRows(events, gate.counts[DAY].in_day)}
    timed("day_load", lambda: load_days(spark, raw_dir, [DAY], counted=counted))
    # The same gate and load in one pass, as a daily run does them.
    verdict, loaded = timed("day_gated_load", lambda: load_gated(spark, raw_dir, [DAY]))
    assert verdict.counts == gate.counts and loaded.rows_written == events
    built = timed("day_marts", lambda: pipeline.refresh_models(spark, days=[DAY]))
    tests = timed("day_tests", lambda: run_model_tests(built).collect())
    by_day = timed("day_tests_by_day", lambda: pipeline.refresh_tests(spark, built, days=[DAY]).collect())
    timed("day_top_repos", lambda: run(serving.top_repos(built["agg_daily_repo_activity"], built["dim_repo"])))
    timed("day_hours", lambda: run(serving.most_active_hours(built["fct_events"])))
    assert all(t.passed for t in tests if t.test != "unique"), tests
    assert sorted(map(tuple, tests)) == sorted(map(tuple, by_day)), by_day
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "day_events": events,
                "gate_events_per_sec": round(events / times["day_gate"]),
                "gate_failures": [f["check"] for f in gate.failures],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
