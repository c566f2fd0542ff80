"""The model chain: staging, flattened events, dimensions, fact and daily rollup.

Every model is a function from DataFrame to DataFrame; Catalyst sees the chain as one plan and reads
only the columns and payload fields the last model asks for.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.functions.json_scalar import json_scalars, whole_number
from eventmill.operators.latest import latest_per_key, sightings

FACT_COLUMNS = (
    "event_id",
    "event_type",
    "actor_id",
    "repo_id",
    "org_id",
    "is_public",
    "action",
    "ref",
    "ref_type",
    "push_commit_count",
    "pull_request_number",
    "issue_number",
    "created_at",
)

# Payload fields of the flattened model.
PAYLOAD_PATHS = {
    "action": "$.action",
    "ref": "$.ref",
    "ref_type": "$.ref_type",
    "push_commit_count": "$.distinct_size",
    "pull_request_number": "$.number",
    "issue_number": "$.issue.number",
}

# The event types the rollup counts.
COUNTED_TYPES = {
    "push_events": "PushEvent",
    "star_events": "WatchEvent",
    "fork_events": "ForkEvent",
    "pull_request_events": "PullRequestEvent",
    "issue_events": "IssuesEvent",
}


def stg_events(raw: DataFrame) -> DataFrame:
    """Renamed and typed raw events; records without id or time are dropped."""
    return raw.where(F.col("id").isNotNull() & F.col("created_at").isNotNull()).select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.nullif("actor.login", F.lit("")).alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("org.id").alias("org_id"),
        F.nullif("org.login", F.lit("")).alias("org_login"),
        "payload",
        F.col("public").alias("is_public"),
        "created_at",
    )


def int_events_flattened(stg: DataFrame) -> DataFrame:
    """Typed payload columns for every event that carries the field, whatever its type."""
    return json_scalars(stg, "payload", PAYLOAD_PATHS).select(
        "event_id",
        "event_type",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "org_id",
        "org_login",
        "is_public",
        "created_at",
        "action",
        "ref",
        "ref_type",
        *[whole_number(c).alias(c) for c in ("push_commit_count", "pull_request_number", "issue_number")],
    )


def dim_repo(flattened: DataFrame) -> DataFrame:
    """One row per repository with its latest name."""
    return latest_per_key(flattened, "repo_id", "repo_name", "created_at")


def dim_actor(flattened: DataFrame) -> DataFrame:
    """One row per actor with its latest login."""
    return latest_per_key(flattened, "actor_id", "actor_login", "created_at")


def daily_sightings(flattened: DataFrame, key: str, value: str) -> DataFrame:
    """Per day, when each (key, value) was last seen: all a dimension needs to know of a day."""
    dated = flattened.where(F.col(key).isNotNull()).withColumn("event_date", F.to_date("created_at"))
    return sightings(dated, value, "created_at", "event_date", key)


def fct_events(flattened: DataFrame) -> DataFrame:
    return flattened.select(*FACT_COLUMNS)


def agg_daily_repo_activity(fact: DataFrame) -> DataFrame:
    """Daily counts per repository; events without a repository belong to none.

    The exact distinct count groups by (day, repo, actor) first, which spreads a hot repository over
    its actors and leaves one partial row per task of the last stage.
    """
    return (
        fact.where(F.col("repo_id").isNotNull())
        .groupBy(F.to_date("created_at").alias("activity_date"), "repo_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            *[F.count_if(F.col("event_type") == t).alias(name) for name, t in COUNTED_TYPES.items()],
            F.count_distinct("actor_id").alias("distinct_actors"),
        )
    )
