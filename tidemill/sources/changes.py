"""Change events of a relational table, and landed issue pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.errors import with_errors
from tidemill.operators.limits import newest
from tidemill.functions.text import contains_any
from tidemill.operators.records import since, url_column

#: read (snapshot), create, update, delete
OPERATIONS = ("r", "c", "u", "d")

# --- fixed values: the issue mapping ----------------------------------------------------
DONE_WORDS = ("done", "closed", "resolved")
HIGH_PRIORITIES = ("Highest", "High")
NO_ASSIGNEE = "Unassigned"
NO_REPORTER = "Unknown"
ISSUE_TOPICS = {"high": "jira.issues.high-priority", "done": "jira.issues.completed", "rest": "jira.issues.all"}
ISSUE_SCHEMA = (
    "key string, fields struct<summary:string, status:struct<name:string>, priority:struct<name:string>, "
    "issuetype:struct<name:string>, assignee:struct<displayName:string>, reporter:struct<displayName:string>, "
    "created:string, updated:string, resolutiondate:string, labels:array<string>, "
    "components:array<struct<name:string>>>"
)
# ----------------------------------------------------------------------------------------


def topic_of(prefix: str, database: str, table: str) -> str:
    """Topic of a table's change events."""
    return f"{prefix}.{database}.{table}"


def read_changes(
    records: DataFrame, row: T.StructType | str, column: str = "value", on_error: str = "reject"
) -> DataFrame:
    """Change events from JSON envelopes: ``op``, ``before``, ``after``, ``ts_ms`` plus the
    record's other columns.  A null value is the tombstone after a delete and is skipped."""
    image = row if isinstance(row, str) else row.simpleString()
    if not image.startswith("struct<"):
        image = f"struct<{image}>"
    shape = f"op string, before {image}, after {image}, ts_ms bigint, _unread string"
    envelope = F.from_json(F.col(column).cast("string"), shape, {"columnNameOfCorruptRecord": "_unread"})
    out = records.filter(F.col(column).isNotNull()).withColumn("_e", envelope)
    bad = F.when(F.col("_e").isNull() | F.col("_e._unread").isNotNull(), "unreadable change event").when(
        F.col("_e.op").isNull() | ~F.col("_e.op").isin(*OPERATIONS), "not a change event"
    ).when(F.when(F.col("_e.op") == "d", F.col("_e.before")).otherwise(F.col("_e.after")).isNull(), "no row image")
    tagged = with_errors(out, bad, on_error, costly=True)
    # the message keeps its body, a good event its row images
    body = [F.when(F.col("_error").isNotNull(), F.col(column)).alias(column)] if "_error" in tagged.columns else []
    rest = [c for c in tagged.columns if c not in ("_e", column, "_error")]
    return tagged.select(*rest, *[F.col(f"_e.{n}") for n in ("op", "before", "after", "ts_ms")], *body, *(["_error"] if body else []))


def as_changes(op: Column, before: Column, after: Column, ts_ms: Column) -> Column:
    """The JSON envelope of one change."""
    return F.to_json(
        F.struct(op.alias("op"), before.alias("before"), after.alias("after"), ts_ms.alias("ts_ms")),
        {"ignoreNullFields": "false"},
    )


def read_issue_pages(
    issues: DataFrame, days: float, limit: int, as_of: datetime | Column, updated: str = "updated", key: str = "key"
) -> DataFrame:
    """The newest issues updated in the last ``days``, at most ``limit``: what one poll returns."""
    return newest(since(issues, updated, days, as_of), [updated, key], limit)


def map_issues(issues: DataFrame, base_url: str) -> DataFrame:
    """Nested issues as flat rows with people defaults and the routing flags."""
    f = F.col("fields")
    return issues.select(
        F.col("key").alias("issue_key"),
        f["summary"].alias("summary"),
        f["status"]["name"].alias("status"),
        f["priority"]["name"].alias("priority"),
        f["issuetype"]["name"].alias("issue_type"),
        url_column(f"{base_url}/browse/", F.col("key")).alias("url"),
        F.when(f["assignee"].isNotNull(), f["assignee"]["displayName"]).otherwise(NO_ASSIGNEE).alias("assignee"),
        F.when(f["reporter"].isNotNull(), f["reporter"]["displayName"]).otherwise(NO_REPORTER).alias("reporter"),
        f["created"].alias("created"),
        f["updated"].alias("updated"),
        f["resolutiondate"].alias("resolved"),
        f["labels"].alias("labels"),
        F.transform(f["components"], lambda c: c["name"]).alias("components"),
        contains_any(f["status"]["name"], DONE_WORDS).alias("is_completed"),
        F.coalesce(f["priority"]["name"].isin(*HIGH_PRIORITIES), F.lit(False)).alias("is_high_priority"),
    )


def issue_rules(topic: dict[str, str] = ISSUE_TOPICS) -> tuple[list[tuple[Column, str]], str]:
    """Routing rules and default topic for :func:`tidemill.operators.records.route`."""
    rules = [(F.col("is_high_priority"), topic["high"]), (F.col("is_completed"), topic["done"])]
    return rules, topic["rest"]
