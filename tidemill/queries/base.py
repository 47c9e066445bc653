"""Registry of the queries and the tables they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.records import to_records
from tidemill.session import configure
from tidemill.sources.files import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: the moment reports are made for
AS_OF = datetime(2024, 1, 30)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL twin if there is one."""

    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    """Concatenation of columns and literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_body() -> Column:
    """A nested JSON document per event."""
    return text(
        '{"user":{"id":', F.col("user_id"), ',"type":"', F.col("event_type"), '"},"props":', F.col("props"),
        ',"tags":["', F.col("event_type"), '",', F.col("event_id"), '],"none":null}',
    )


def records_of(events: DataFrame) -> DataFrame:
    """Events as records: key = user, one topic per event type, four partitions."""
    return to_records(
        events,
        text("events-", F.col("event_type")),
        event_body(),
        F.col("user_id").cast("string"),
        F.col("event_id") % 4,
        F.expr("event_id div 4"),
        F.col("ts"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "events"))


#: the same records in SQL
REC = """
rec AS (
  SELECT CAST(user_id AS VARCHAR) AS key,
         '{"user":{"id":' || user_id || ',"type":"' || event_type || '"},"props":' || props
           || ',"tags":["' || event_type || '",' || event_id || '],"none":null}' AS value,
         'events-' || event_type AS topic, CAST(event_id % 4 AS INTEGER) AS part, event_id // 4 AS off,
         ts, event_id, user_id, event_type, props
  FROM events)
"""


def micros(col: Column | str) -> Column:
    """Epoch microseconds of a timestamp column."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def readable(df: DataFrame) -> DataFrame:
    """Records with text keys and values and plain numbers, for comparison."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        micros("timestamp").alias("ts_us"),
    )


READABLE = "key, value, topic, part, off, epoch_us(ts) AS ts_us"
