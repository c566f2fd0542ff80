"""The raw event schema and the domain constants, in one copy."""

from pyspark.sql import types as T

# The raw event record. Every field is nullable; ``id`` is text although it looks
# numeric, and the shape of ``payload`` varies with the event type.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "actor",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("login", T.StringType()),
                    T.StructField("display_login", T.StringType()),
                    T.StructField("gravatar_id", T.StringType()),
                    T.StructField("url", T.StringType()),
                    T.StructField("avatar_url", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "repo",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("url", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "org",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("login", T.StringType()),
                    T.StructField("gravatar_id", T.StringType()),
                    T.StructField("url", T.StringType()),
                    T.StructField("avatar_url", T.StringType()),
                ]
            ),
        ),
        T.StructField("payload", T.VariantType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# The known event types.
KNOWN_EVENT_TYPES = (
    "CommitCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "DiscussionEvent",
    "DiscussionCommentEvent",
    "ForkEvent",
    "GollumEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "MemberEvent",
    "PublicEvent",
    "PullRequestEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "PullRequestReviewThreadEvent",
    "PushEvent",
    "ReleaseEvent",
    "SponsorshipEvent",
    "WatchEvent",
)

# Gate rules. ``org`` is allowed but not required.
REQUIRED_COLUMNS = ("id", "type", "actor", "repo", "payload", "public", "created_at")
CRITICAL_COLUMNS = ("id", "type", "created_at")
TOLERATED_PERCENT = 1
BUFFER_HOURS = 6
SAMPLE_SIZE = 2000

# Landing window and retention.
PUBLISH_DELAY_HOURS = 2
WINDOW_HOURS = 24
RETENTION_DAYS = 60
