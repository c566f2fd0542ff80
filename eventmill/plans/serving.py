"""The eight activity reports over the marts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: length of the repository ranking.
TOP_REPOS = 10


def daily_event_volume(agg: DataFrame) -> DataFrame:
    return agg.groupBy("activity_date").agg(F.sum("total_events").alias("total_events")).orderBy("activity_date")


def repo_totals(agg: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """Events per repository name; repositories sharing a name count together.

    Days are summed per repository before the join, so each repository meets its name once.
    """
    per_repo = agg.groupBy("repo_id").agg(F.sum("total_events").alias("events"))
    return (
        per_repo.join(dim_repo, "repo_id").groupBy("repo_name").agg(F.sum("events").alias("total_events"))
    )


def top_repos(agg: DataFrame, dim_repo: DataFrame, n: int = TOP_REPOS) -> DataFrame:
    """The busiest repository names; equal totals are ordered by name."""
    return repo_totals(agg, dim_repo).orderBy(F.desc("total_events"), F.asc_nulls_last("repo_name")).limit(n)


def most_active_hours(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.hour("created_at").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("hour_of_day")
    )


def event_type_breakdown(fact: DataFrame) -> DataFrame:
    return fact.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy(F.desc("event_count"), "event_type")


def total_events(agg: DataFrame) -> DataFrame:
    """Events with a repository; null over an empty rollup."""
    return agg.agg(F.sum("total_events").alias("total_events"))


def repositories_tracked(dim_repo: DataFrame) -> DataFrame:
    return dim_repo.agg(F.count(F.lit(1)).alias("repo_count"))


def contributors_tracked(dim_actor: DataFrame) -> DataFrame:
    return dim_actor.agg(F.count(F.lit(1)).alias("actor_count"))


def pull_request_activity(agg: DataFrame) -> DataFrame:
    return agg.agg(F.sum("pull_request_events").alias("pr_events"))
