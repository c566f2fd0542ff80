"""The given ``events`` table as a raw feed and as landed files.

Names change with the event type, so the latest name of a key depends on its newest event; payloads
hold scalars, objects, arrays and nulls; key 0 gives events without a repository.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions.hours import PATH_FORMAT
from eventmill.session import setting, shared_dir
from eventmill.sources.landing import landed_hours

# Expressions over (event_id, ts, user_id, event_type, value, k) that read the same in both engines.
EVENT_TYPE = (
    "case event_type when 'click' then 'PushEvent' when 'view' then 'WatchEvent' "
    "when 'signup' then 'ForkEvent' when 'purchase' then 'PullRequestEvent' else 'IssuesEvent' end"
)
ACTOR_LOGIN = "case when event_type = 'error' then '' else 'u' || user_id || '-' || event_type end"
REPO_NAME = "'r' || cast(floor(k / 2.0) as bigint) || '/' || event_type"
ORG_ID = "case when event_type in ('purchase', 'view') then cast(floor(user_id / 60.0) as bigint) end"
ORG_LOGIN = "case when user_id < 60 then '' else 'org' || cast(floor(user_id / 60.0) as bigint) end"
PAYLOAD = """
'{"action":' || case event_type when 'click' then '"opened"' when 'view' then '{"b":1}'
    when 'signup' then '[1]' when 'purchase' then 'null' else 'true' end
|| ',"distinct_size":' || case event_type when 'click' then '' || k when 'view' then '"' || k || '"'
    when 'signup' then '12.7' else '"n' || k || '"' end
|| ',"issue":' || case when event_type = 'error' then '{"number":' || k || '}' else '"' || k || '"' end
|| case when event_type = 'purchase' then ',"number":' || event_id else '' end
|| ',"ref":' || case when event_type = 'signup' then '"{' || k || '}"' else '"refs/' || k || '"' end
|| case when event_type = 'signup' then ',"ref_type":"branch"' else '' end
|| '}'
"""
# Minutes (landed files) or hours (faulty feed) between an event and the file it arrives in.
LAG = "cast(floor(value / 10) as int)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    )


def _text(expression: str) -> Column:
    return F.expr(expression).cast("string")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records in the raw schema, plus ``land_hour``."""
    none = F.lit(None).cast("string")
    repo = F.struct(F.col("k").alias("id"), _text(REPO_NAME).alias("name"), none.alias("url"))
    org = F.struct(
        F.expr(ORG_ID).alias("id"),
        _text(ORG_LOGIN).alias("login"),
        *[none.alias(c) for c in ("gravatar_id", "url", "avatar_url")],
    )
    actor = F.struct(
        F.col("user_id").alias("id"),
        _text(ACTOR_LOGIN).alias("login"),
        *[none.alias(c) for c in ("display_login", "gravatar_id", "url", "avatar_url")],
    )
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("id"),
        _text(EVENT_TYPE).alias("type"),
        actor.alias("actor"),
        F.when(F.col("k") != 0, repo).alias("repo"),
        F.when(F.col("event_type").isin("purchase", "view"), org).alias("org"),
        F.parse_json(F.expr(PAYLOAD)).alias("payload"),
        (F.col("value") < 100).alias("public"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.date_trunc("hour", F.expr(f"cast(ts as timestamp) + make_dt_interval(0, 0, {LAG}, 0)")).alias("land_hour"),
    )


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with faults of every kind the gate and the model tests look for."""
    late = F.expr(f"cast(ts as timestamp) + make_dt_interval(0, {LAG}, 0, 0)")
    ids = F.col("event_id").cast("string")
    return events(spark, sf_dir).select(
        F.when(F.col("value") < 0.5, None).when(F.col("value") > 300, F.lit("dup")).otherwise(ids).alias("id"),
        F.when(F.col("value").between(20, 20.4), None)
        .when(F.col("value") > 250, F.concat(F.lit("odd-"), "event_type"))
        .otherwise(_text(EVENT_TYPE))
        .alias("type"),
        F.struct(F.col("user_id").alias("id"), _text(ACTOR_LOGIN).alias("login")).alias("actor"),
        F.struct(F.col("k").alias("id"), _text(REPO_NAME).alias("name")).alias("repo"),
        F.struct(F.expr(ORG_ID).alias("id"), _text(ORG_LOGIN).alias("login")).alias("org"),
        F.parse_json(F.expr(PAYLOAD)).alias("payload"),
        F.lit(True).alias("public"),
        F.when(~F.col("value").between(40, 40.4), F.col("ts").cast("timestamp")).alias("created_at"),
        F.to_date(late).alias("land_date"),
        F.concat(
            F.array(*[F.lit(c) for c in ("id", "type", "actor", "repo", "payload", "created_at")]),
            F.when(F.col("value") > 400, F.array(F.lit("public"), F.lit("extra"))).otherwise(F.array().cast("array<string>")),
        ).alias("keys"),
    )


# Mishaps of a landing: hours that never came, a day without files, a day of unknown types.
LOST_DAY, LOST_HOURS = dt.date(2024, 1, 5), (13, 15)
MISSING_DAY, ODD_DAY = dt.date(2024, 1, 9), dt.date(2024, 1, 12)


def _mishaps(records: DataFrame) -> DataFrame:
    day, hour = F.to_date("land_hour"), F.hour("land_hour")
    lost = (day == F.lit(LOST_DAY)) & hour.between(*LOST_HOURS)
    odd = F.when(day == F.lit(ODD_DAY), F.concat(F.lit("odd-"), "type")).otherwise(F.col("type"))
    return records.where(~lost & (day != F.lit(MISSING_DAY))).withColumn("type", odd)


def _retracted(records: DataFrame) -> DataFrame:
    """What the feed's owner sends again after taking the issues back."""
    return records.where(F.col("type") != "IssuesEvent")


#: How a landing differs from the feed.
VERSIONS = {"plain": lambda records: records, "mishaps": _mishaps, "retracted": _retracted}

_landings: dict[tuple[str, str, str], str] = {}


def landing(spark: SparkSession, sf_dir: str, version: str = "plain") -> str:
    """The feed as gzipped JSON lines under ``raw/YYYY/MM/DD/H.json.gz``, written once per session.

    Spark writes each hour as a folder of parts, so a crowded hour is not one task's work. The part, or
    the folder where there are several, then gets the landing name.
    """
    if version == "faulty":
        records = faulty_events(spark, sf_dir)
        marked = {k: F.when(F.array_contains("keys", k), F.lit(True)) for k in ("public", "extra")}
        records = records.withColumns({**marked, "land_hour": F.col("land_date").cast("timestamp")})
    else:
        records = VERSIONS[version](raw_events(spark, sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir, version)
    if key in _landings:
        return _landings[key]
    staged, raw_dir = shared_dir(spark, "staged"), shared_dir(spark, "raw")
    named = records.withColumns(
        {
            "position": F.monotonically_increasing_id() if version == "faulty" else F.col("id").cast("bigint"),
            "land": F.date_format("land_hour", PATH_FORMAT.replace("/", "-")),
            "created_at": F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        }
    ).drop("land_hour", "land_date", "keys")
    # Many small files: worth a task per core even where the bytes would fit one.
    with setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b"):
        (
            named.hint("rebalance", F.col("land"))
            .sortWithinPartitions("land", "position")
            .drop("position")
            .write.partitionBy("land")
            .option("compression", "gzip")
            .json(staged)
        )
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{staged}/land=*")):
        folder = status.getPath()
        year, month, day, hour = folder.getName()[len("land=") :].split("-")
        parent = path(f"{raw_dir}/{year}/{month}/{day}")
        fs.mkdirs(parent)
        parts = fs.globStatus(path(folder, "part-*"))
        landed = parts[0].getPath() if len(parts) == 1 else folder
        fs.rename(landed, path(parent, f"{hour}.json.gz"))
    _landings[key] = raw_dir
    return raw_dir


def landed_days(spark: SparkSession, raw_dir: str) -> list[dt.date]:
    days = landed_hours(spark, raw_dir).select(F.to_date("hour").alias("day")).distinct()
    return sorted(row.day for row in days.collect())
