"""One entry per operator: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmill.functions.hours import explode_hours, hour_grid, hour_key, hour_path, trailing_window
from eventmill.operators import delta_tests, gate, model_tests
from eventmill.plans import models, pipeline, serving
from eventmill.plans.load import OBSERVED_DAYS, load_days, load_gated
from eventmill.session import local_frame, pin, shared_dir
from eventmill.sinks import tables
from eventmill.sources import landing as landing_source
from eventmill.sources import raw as raw_source
from eventmill.schema import RAW_SCHEMA
from harness import feed

AS_OF = dt.date(2024, 3, 15)
NOW = dt.datetime(2024, 2, 1)
KEPT_DAYS = 20


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables have them."""
    zoned = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# ---- landing --------------------------------------------------------------------------------------


def q_hour_grid(spark, sf):
    bounds = feed.raw_events(spark, sf).agg(F.min("created_at").alias("start"), F.max("created_at").alias("end"))
    grid = explode_hours(bounds)
    return grid.select("hour", hour_path(F.col("hour")).alias("path"), hour_key(F.col("hour")).alias("key"))


def q_trailing_window(spark, sf):
    now = feed.raw_events(spark, sf).agg(F.max("created_at").cast("timestamp_ntz").alias("now")).first().now
    return hour_grid(spark, *trailing_window(now))


def q_landed_hours(spark, sf):
    landed = landing_source.landed_hours(spark, feed.landing(spark, sf))
    return landed.select("hour", (F.col("length") > 0).alias("has_bytes"))


def q_day_files(spark, sf):
    """Files of every landed day with their place in numeric hour order, from one listing."""
    raw_dir = feed.landing(spark, sf)
    files = landing_source.days_files(spark, raw_dir, feed.landed_days(spark, raw_dir))
    # A crowded hour is a folder of parts here; its rank and its own path are those of the hour.
    hourly = F.regexp_extract("path", r"(\d{4}/\d{2}/\d{2}/\d{1,2}\.json\.gz)", 1)
    ranked = files.select("day", "hour", hourly.alias("path")).distinct()
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy("day").orderBy("hour")))


def _listings(spark, sf):
    """Landed and remote sides from the events: sizes are sums of user ids, so that they can disagree."""
    hourly = (
        feed.events(spark, sf)
        .groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
        .agg(
            F.sum("user_id").alias("remote"),
            F.sum(F.when(F.col("value") < 200, F.col("user_id"))).alias("local"),
            F.max("value").alias("top"),
            F.min("user_id").alias("lowest"),
        )
    )
    landed = hourly.where(F.col("top") < 270).select(
        "hour", hour_path(F.col("hour")).alias("path"), F.coalesce("local", F.lit(0)).alias("length")
    )
    manifest = hourly.select(
        "hour",
        (F.col("top") > 90).alias("exists"),
        F.when(F.col("lowest") > 0, F.col("remote")).alias("content_length"),
    )
    bounds = hourly.agg(F.min("hour").alias("start"), (F.max("hour") + F.expr("interval 3 hours")).alias("end"))
    return explode_hours(bounds), landed, manifest


def q_sync_plan(spark, sf):
    return landing_source.sync_plan(*_listings(spark, sf))


def q_sync_plan_forced(spark, sf):
    return landing_source.sync_plan(*_listings(spark, sf), force=True)


def q_sync_summary(spark, sf):
    grid, landed, manifest = _listings(spark, sf)
    plan = landing_source.sync_plan(grid, landed, manifest)
    # The copy step brought every published hour whose size is known.
    after = manifest.where("exists and content_length is not null").select(
        "hour", F.col("content_length").alias("length")
    )
    return landing_source.sync_summary(landing_source.sync_result(plan, after))


# ---- scans ----------------------------------------------------------------------------------------


def _landed(spark, sf, version="plain"):
    raw_dir = feed.landing(spark, sf, version)
    return raw_dir, feed.landed_days(spark, raw_dir)


def q_jsonl_scan(spark, sf):
    scanned = raw_source.read_events(spark, *_landed(spark, sf))
    return scanned.select(
        "id",
        "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("org.id").alias("org_id"),
        F.col("org.login").alias("org_login"),
        F.to_json("payload").alias("payload"),
        F.col("public").alias("public_event"),
        "created_at",
        "land_date",
    )


def q_light_scan(spark, sf):
    return raw_source.read_light(spark, *_landed(spark, sf))


def q_sample_lines(spark, sf):
    raw_dir, days = _landed(spark, sf)
    sample = raw_source.sample_lines(spark, raw_dir, days[0])
    return sample.select(F.get_json_object("value", "$.id").alias("id"))


def q_sample_lines_bounded(spark, sf):
    """A sample smaller than its day; the bound is the operator's parameter."""
    raw_dir, days = _landed(spark, sf)
    sample = raw_source.sample_lines(spark, raw_dir, days[0], 100)
    return sample.select(F.get_json_object("value", "$.id").alias("id"))


def q_source_freshness(spark, sf):
    limits = dt.timedelta(days=1), dt.timedelta(days=3)
    return raw_source.freshness(feed.raw_events(spark, sf), NOW, *limits)


# ---- gate -----------------------------------------------------------------------------------------


def q_gate_landed_days(spark, sf):
    return gate.run_gate(spark, *_landed(spark, sf)).checks


def q_gate_faulty_days(spark, sf):
    return gate.check_rows(gate.day_counts(feed.faulty_events(spark, sf)))


def q_gate_one_batch(spark, sf):
    """All events judged as one day's batch, so the range check has to fail."""
    first = F.lit(dt.date(2024, 1, 1))
    return gate.check_rows(gate.day_counts(feed.faulty_events(spark, sf).withColumn("land_date", first)))


def q_gate_failure_samples(spark, sf):
    return gate.unexpected_samples(feed.faulty_events(spark, sf))


def q_gate_unlisted_keys(spark, sf):
    return gate.unlisted_keys(feed.faulty_events(spark, sf), RAW_SCHEMA.fieldNames())


def q_gate_failure_values(spark, sf):
    """Every offending value of the faulty feed as it landed, read from its text."""
    return gate.unexpected_values(raw_source.read_light(spark, *_landed(spark, sf, "faulty")))


def q_gate_landed_unlisted_keys(spark, sf):
    """Keys beyond five listed ones, per day, read from landed text; some stand in all records, some in few."""
    keys = raw_source.read_envelopes(spark, *_landed(spark, sf, "faulty"))
    return gate.unlisted_keys(keys, ("id", "type", "actor", "repo", "created_at"))


# ---- tables ---------------------------------------------------------------------------------------


def _fresh_prefix(spark: SparkSession) -> str:
    """A database prefix of its own, its databases lying in the shared folder."""
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    root = shared_dir(spark, "databases")
    for name in ("raw", "prod_intermediate", "prod_marts"):
        tables.ensure_database(spark, prefix + name, f"{root}/{name}")
    return prefix


def _loaded(spark, sf):
    prefix = _fresh_prefix(spark)
    raw_dir, days = _landed(spark, sf)
    table = f"{prefix}raw.events"
    result = load_days(spark, raw_dir, days, table, strict=False)
    return prefix, raw_dir, days, table, result


def q_day_overwrite(spark, sf):
    """Load every day, then load the first one again: nothing doubles and no other day changes."""
    _, raw_dir, days, table, _ = _loaded(spark, sf)
    load_days(spark, raw_dir, days[:1], table, strict=False)
    stored = spark.table(table)
    return stored.groupBy("event_date", "type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids")
    )


def q_loaded_row_count(spark, sf):
    result = _loaded(spark, sf)[-1]
    rows = [(day, n, result.rejected.get(day, 0)) for day, n in result.loaded.items()]
    return local_frame(spark, rows, "land_date date, loaded bigint, rejected bigint")


def q_gated_load(spark, sf):
    """Gate and load in one pass over a landing with mishaps: the verdict, the counts of the load and the rows that the table then holds."""
    table = f"{_fresh_prefix(spark)}raw.events"
    tables.ensure_raw_table(spark, table)
    raw_dir, days = _landed(spark, sf, "mishaps")
    rows = []
    for first in range(0, len(days), OBSERVED_DAYS):
        batch = days[first : first + OBSERVED_DAYS]
        verdict, load = load_gated(spark, raw_dir, batch, table, strict=False)
        odd = {f["land_date"]: f["unexpected_count"] for f in verdict.failures if f["check"] == "in_set"}
        for day in batch:
            passed = day not in verdict.failed_days
            loaded = (load.loaded[day], load.rejected.get(day, 0)) if passed else (None, None)
            rows.append((day, verdict.counts[day].total, passed, odd.get(day, 0), *loaded))
    judged = local_frame(spark, rows, "land_date date, records bigint, passed boolean, odd_types bigint, loaded bigint, rejected bigint")
    stored = spark.table(table).groupBy(F.col("event_date").alias("land_date")).agg(F.count(F.lit(1)).alias("stored"))
    return judged.join(stored, "land_date", "left")


def q_straggler_rejects(spark, sf):
    table = _loaded(spark, sf)[3]
    return spark.table(table + tables.REJECTS_SUFFIX).select("id", "type", "created_at", "event_date")


def q_partition_retention(spark, sf):
    table = _loaded(spark, sf)[3]
    tables.expire_days(spark, table, AS_OF)
    return spark.table(table).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_pruned_range_scan(spark, sf):
    table = _loaded(spark, sf)[3]
    part = raw_source.within_days(spark.table(table), dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    return part.groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"))


def q_daily_run(spark, sf):
    """Gate, load, day-wise mart refresh and the declared tests over every landed day."""
    prefix = _fresh_prefix(spark)
    raw_dir, days = _landed(spark, sf)
    return pipeline.run_days(
        spark, raw_dir, days, f"{prefix}raw.events", target="prod", strict=False, prefix=prefix
    ).tests


#: What stands for a row of each model: its key, a text and a number.
MODEL_ROWS = (
    ("stg_events", "event_id", "event_type", "actor_id"),
    ("int_events_flattened", "event_id", "action", "push_commit_count"),
    ("fct_events", "event_id", "event_type", "repo_id"),
    ("agg_daily_repo_activity", "repo_id", "activity_date", "total_events"),
    ("dim_repo", "repo_id", "repo_name", "repo_id"),
    ("dim_actor", "actor_id", "actor_login", "actor_id"),
)


def _model_rows(built, listed=MODEL_ROWS):
    """(model, key, label, number) of every row of the models."""
    parts = [
        built[model].select(
            F.lit(model).alias("model"),
            F.col(key).cast("string").alias("key"),
            F.col(label).cast("string").alias("label"),
            F.col(number).cast("bigint").alias("number"),
        )
        for model, key, label, number in listed
    ]
    return reduce(DataFrame.unionAll, parts)


def q_run_outcome(spark, sf):
    """The whole chain over a landing with mishaps: what became of each day that the feed holds."""
    prefix = _fresh_prefix(spark)
    records = feed.raw_events(spark, sf)
    manifest = records.select(F.col("land_hour").alias("hour"), F.lit(True).alias("exists"), F.lit(None).cast("bigint").alias("content_length"))
    days = feed.landed_days(spark, feed.landing(spark, sf))
    run = pipeline.run_days(
        spark, feed.landing(spark, sf, "mishaps"), days, f"{prefix}raw.events", target="prod", strict=False, prefix=prefix,
        manifest=manifest.distinct(), keep_days=KEPT_DAYS, enforce=False,
    )
    return run.outcome


def q_reload_recovery(spark, sf):
    """All marts after a day was loaded again with fewer rows and its run died before the models."""
    prefix = _fresh_prefix(spark)
    raw_dir, days = _landed(spark, sf)
    table = f"{prefix}raw.events"
    load_days(spark, raw_dir, days[:-1], table, strict=False)
    pipeline.refresh_models(spark, table, days[:-1], prefix=prefix)
    load_days(spark, feed.landing(spark, sf, "retracted"), days[:1], table, strict=False)
    load_days(spark, raw_dir, days[-1:], table, strict=False)
    built = pipeline.refresh_models(spark, table, days[-1:], prefix=prefix)

    return _model_rows(built, MODEL_ROWS[2:])


def q_reloaded_rows(spark, sf):
    """The raw table's rows after its first day was replaced by fewer; no other day changes."""
    _, _, days, table, _ = _loaded(spark, sf)
    load_days(spark, feed.landing(spark, sf, "retracted"), days[:1], table, strict=False)
    return spark.table(table).select("id", "type", F.col("repo.id").alias("repo_id"), F.to_json("payload").alias("payload"), "created_at", "event_date")


_day_wise: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _day_wise_marts(spark, sf):
    """Half of the days, then the rest, then one day again; built once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _day_wise:
        return _day_wise[key]
    prefix = _fresh_prefix(spark)
    raw_dir, days = _landed(spark, sf)
    table = f"{prefix}raw.events"
    built = {}
    for batch in (days[::2], days[1::2], days[:1]):
        load_days(spark, raw_dir, batch, table, strict=False)
        built = pipeline.refresh_models(spark, table, batch, prefix=prefix)
    _day_wise[key] = built
    return built


def q_day_wise_rollup(spark, sf):
    return _day_wise_marts(spark, sf)["agg_daily_repo_activity"]


def q_repo_lookup(spark, sf):
    """Events of the repository with the most of them, by day and type, from a fact that is stored by day with Bloom filters of repositories."""
    fact = _day_wise_marts(spark, sf)["fct_events"]
    most = fact.where("repo_id IS NOT NULL").groupBy("repo_id").count().orderBy(F.desc("count"), "repo_id").first()
    found = fact.where(F.col("repo_id") == (most.repo_id if most else None))
    return found.groupBy(F.to_date("created_at").alias("event_date"), "event_type").agg(F.count(F.lit(1)).alias("events"))


def q_day_wise_dims(spark, sf):
    built = _day_wise_marts(spark, sf)
    repos = built["dim_repo"].select(F.lit("repo").alias("dim"), F.col("repo_id").alias("id"), F.col("repo_name").alias("label"))
    actors = built["dim_actor"].select(F.lit("actor").alias("dim"), F.col("actor_id").alias("id"), F.col("actor_login").alias("label"))
    return repos.unionAll(actors)


def q_dims_after_expiry(spark, sf):
    """Both dimensions after a day was replaced by fewer rows and the oldest days expired."""
    prefix, _, days, table, _ = _loaded(spark, sf)
    pipeline.refresh_models(spark, table, prefix=prefix)
    load_days(spark, feed.landing(spark, sf, "retracted"), days[-1:], table, strict=False)
    tables.expire_days(spark, table, days[-1], KEPT_DAYS)
    return _model_rows(pipeline.refresh_models(spark, table, days[-1:], prefix=prefix), MODEL_ROWS[4:])


def q_tests_by_day(spark, sf):
    """The declared tests on the faulty feed, kept up by the day: most days, then the last ones and one of them again, then without the oldest."""
    prefix = _fresh_prefix(spark)
    raw_dir, days = _landed(spark, sf, "faulty")
    table = f"{prefix}raw.events"
    for batch in (days[:-3], days[-4:]):
        load_days(spark, raw_dir, batch, table, strict=False)
        built = pipeline.refresh_models(spark, table, batch, prefix=prefix)
        pipeline.refresh_tests(spark, built, table, batch, prefix=prefix)
    tables.expire_days(spark, table, days[-1], KEPT_DAYS)
    built = pipeline.refresh_models(spark, table, prefix=prefix)
    return pipeline.refresh_tests(spark, built, table, prefix=prefix)


def _halves(index: DataFrame) -> tuple[list[dt.date], list[dt.date]]:
    days = sorted(row.event_date for row in index.select("event_date").distinct().collect())
    return days[: len(days) // 2], days[len(days) // 2 :]


def q_duplicates_by_day(spark, sf):
    """Ids that occur more than once in the faulty feed, from half of its days and then from the other half."""
    stg = models.stg_events(feed.faulty_events(spark, sf)).withColumn("event_date", F.to_date("created_at"))
    index = delta_tests.value_counts(stg, "event_id")
    first, second = _halves(index)
    known = delta_tests.updated_duplicates(index.where(F.col("event_date").isin(first)), "event_id", first)
    return delta_tests.updated_duplicates(index, "event_id", second, known)


def q_orphans_by_day(spark, sf):
    """Order keys of line items that the dear orders lack, after half of the days came in and some orders left."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("event_date", F.to_date(F.date_trunc("month", "l_shipdate")))
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    before, now = (orders.where(F.col("o_totalprice") > price) for price in (100000, 150000))
    index = delta_tests.value_counts(lines, "l_orderkey")
    first, second = _halves(index)
    known = delta_tests.updated_orphans(index.where(F.col("event_date").isin(first)), "l_orderkey", first, before, "o_orderkey")
    return delta_tests.updated_orphans(index, "l_orderkey", second, now, "o_orderkey", before, known)


def q_mart_tables(spark, sf):
    """Two full builds for prod: marts are tables, the fact by day and clustered by type."""
    prefix, _, _, table, _ = _loaded(spark, sf)
    pipeline.build_models(spark, spark.table(table), "prod", prefix)
    return _model_rows(pipeline.build_models(spark, spark.table(table), "prod", prefix))


def q_dev_views(spark, sf):
    """Two full builds for dev: every model is a view over the feed."""
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    pipeline.build_models(spark, feed.raw_events(spark, sf), "dev", prefix)
    return _model_rows(pipeline.build_models(spark, feed.raw_events(spark, sf), "dev", prefix))


# ---- models ---------------------------------------------------------------------------------------


def _flattened(spark, sf):
    return models.int_events_flattened(models.stg_events(feed.raw_events(spark, sf)))


def _fact(spark, sf):
    return models.fct_events(_flattened(spark, sf))


def _rollup(spark, sf):
    return models.agg_daily_repo_activity(_fact(spark, sf))


def _dim_repo(spark, sf):
    return models.dim_repo(_flattened(spark, sf))


def _dim_actor(spark, sf):
    return models.dim_actor(_flattened(spark, sf))


def q_stg_events(spark, sf):
    stg = models.stg_events(feed.raw_events(spark, sf))
    return stg.withColumn("payload", F.to_json("payload"))


def q_stg_faulty_events(spark, sf):
    """Records without id or time are dropped, unknown types are kept."""
    return models.stg_events(feed.faulty_events(spark, sf)).drop("payload")


# ---- model tests ----------------------------------------------------------------------------------


def q_model_tests(spark, sf):
    """The declared tests on a chain built from the faulty feed; dimensions come from a part of it."""
    stg = models.stg_events(feed.faulty_events(spark, sf))
    flattened = models.int_events_flattened(stg)
    known = flattened.where(F.col("event_type") == "PushEvent")
    fact = models.fct_events(flattened)
    return model_tests.run_model_tests(
        {
            "stg_events": stg,
            "dim_repo": models.dim_repo(known),
            "dim_actor": models.dim_actor(known.where(F.col("actor_id") > 20)),
            "fct_events": fact,
            "agg_daily_repo_activity": models.agg_daily_repo_activity(fact),
        }
    )


def q_test_unique(spark, sf):
    return model_tests.duplicate_values(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_orderkey")


def q_test_accepted_values(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet")
    return model_tests.unaccepted_values(parts, "p_brand", ("Brand#11", "Brand#12", "Brand#13"))


def q_test_relationships(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    high = orders.where(F.col("o_totalprice") > 100000)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return model_tests.orphan_values(lines, "l_orderkey", high, "o_orderkey")


def q_test_not_null(spark, sf):
    """One row per declared not-null test of the faulty staging model."""
    stg = models.stg_events(feed.faulty_events(spark, sf))
    specs = [model_tests.ColumnTests("stg_events", c, not_null=True) for c in stg.columns if c != "payload"]
    return model_tests.run_model_tests({"stg_events": stg}, specs)


QUERIES = {
    "hour_grid": q_hour_grid,
    "trailing_window": q_trailing_window,
    "landed_hours": q_landed_hours,
    "day_files": q_day_files,
    "sync_plan": q_sync_plan,
    "sync_plan_forced": q_sync_plan_forced,
    "sync_summary": q_sync_summary,
    "jsonl_scan": q_jsonl_scan,
    "light_scan": q_light_scan,
    "sample_lines": q_sample_lines,
    "sample_lines_bounded": q_sample_lines_bounded,
    "source_freshness": q_source_freshness,
    "gate_landed_days": q_gate_landed_days,
    "gate_faulty_days": q_gate_faulty_days,
    "gate_one_batch": q_gate_one_batch,
    "gate_failure_samples": q_gate_failure_samples,
    "gate_unlisted_keys": q_gate_unlisted_keys,
    "gate_failure_values": q_gate_failure_values,
    "gate_landed_unlisted_keys": q_gate_landed_unlisted_keys,
    "day_overwrite": q_day_overwrite,
    "reloaded_rows": q_reloaded_rows,
    "run_outcome": q_run_outcome,
    "reload_recovery": q_reload_recovery,
    "loaded_row_count": q_loaded_row_count,
    "gated_load": q_gated_load,
    "straggler_rejects": q_straggler_rejects,
    "partition_retention": q_partition_retention,
    "pruned_range_scan": q_pruned_range_scan,
    "daily_run": q_daily_run,
    "day_wise_rollup": q_day_wise_rollup,
    "day_wise_dims": q_day_wise_dims,
    "repo_lookup": q_repo_lookup,
    "dims_after_expiry": q_dims_after_expiry,
    "tests_by_day": q_tests_by_day,
    "duplicates_by_day": q_duplicates_by_day,
    "orphans_by_day": q_orphans_by_day,
    "mart_tables": q_mart_tables,
    "dev_views": q_dev_views,
    "stg_events": q_stg_events,
    "stg_faulty_events": q_stg_faulty_events,
    "int_events_flattened": _flattened,
    "fct_events": _fact,
    "dim_repo": _dim_repo,
    "dim_actor": _dim_actor,
    "agg_daily_repo_activity": _rollup,
    "daily_event_volume": lambda s, d: serving.daily_event_volume(_rollup(s, d)),
    "repo_totals": lambda s, d: serving.repo_totals(_rollup(s, d), _dim_repo(s, d)),
    "top_repos": lambda s, d: serving.top_repos(_rollup(s, d), _dim_repo(s, d)),
    "most_active_hours": lambda s, d: serving.most_active_hours(_fact(s, d)),
    "event_type_breakdown": lambda s, d: serving.event_type_breakdown(_fact(s, d)),
    "total_events_tracked": lambda s, d: serving.total_events(_rollup(s, d)),
    "repositories_tracked": lambda s, d: serving.repositories_tracked(_dim_repo(s, d)),
    "contributors_tracked": lambda s, d: serving.contributors_tracked(_dim_actor(s, d)),
    "pull_request_activity": lambda s, d: serving.pull_request_activity(_rollup(s, d)),
    "model_tests": q_model_tests,
    "test_unique": q_test_unique,
    "test_not_null": q_test_not_null,
    "test_accepted_values": q_test_accepted_values,
    "test_relationships": q_test_relationships,
}


def _pinned(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(pin(spark), sf_dir))

    return run


def registry():
    return {name: _pinned(query) for name, query in QUERIES.items()}
