"""Topic scans: Kafka when the session has the connector, parquet records otherwise."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.records import RECORD_SCHEMA
from tidemill.plans.skew import lookup_join

StartingOffsets = str | Mapping[tuple[str, int], int]


def has_kafka(spark: SparkSession) -> bool:
    """Whether the Kafka source is on the class path."""
    try:
        spark._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider",
            False,
            spark._jvm.java.lang.Thread.currentThread().getContextClassLoader(),
        )
        return True
    except Exception:
        return False


def starting_offsets_json(offsets: Mapping[tuple[str, int], int]) -> str:
    """Explicit start offsets as the Kafka source wants them."""
    nested: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in sorted(offsets.items()):
        nested.setdefault(topic, {})[str(partition)] = offset
    return json.dumps(nested)


def read_topic(
    spark: SparkSession,
    topic: str | None = None,
    pattern: str | None = None,
    path: str | None = None,
    servers: str | None = None,
    streaming: bool = False,
    starting_offsets: StartingOffsets = "earliest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Records of one topic, or of all topics whose whole name matches ``pattern``.

    With ``servers`` the Kafka source is used, with ``path`` a folder of parquet records.
    ``starting_offsets`` is ``earliest``, ``latest`` or ``{(topic, partition): offset}``.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    reader = (spark.readStream if streaming else spark.read).options(**(options or {}))
    if servers is not None:
        if not has_kafka(spark):
            raise RuntimeError("the Kafka connector is not on the class path")
        start = starting_offsets if isinstance(starting_offsets, str) else starting_offsets_json(starting_offsets)
        which = ("subscribe", topic) if topic is not None else ("subscribePattern", pattern)
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option(*which)
            .option("startingOffsets", start)
            .load()
        )
    if path is None:
        raise ValueError("give servers or a path")
    rows = reader.schema(RECORD_SCHEMA).parquet(path)
    rows = rows.filter(F.col("topic") == topic) if topic is not None else subscribe_pattern(rows, pattern)
    return from_offsets(rows, starting_offsets)


def subscribe_pattern(records: DataFrame, pattern: str) -> DataFrame:
    """Records of the topics whose whole name matches."""
    return records.filter(F.col("topic").rlike(f"^(?:{pattern})$"))


def from_offsets(records: DataFrame, start: StartingOffsets) -> DataFrame:
    """Records from a start position on.

    Partitions that an explicit position does not name start at their beginning.  The
    position is one number per partition and becomes part of the filter.
    """
    if start == "earliest":
        return records
    if start == "latest":
        return records.filter(F.lit(False))
    if isinstance(start, str):
        raise ValueError(f"unknown start position {start!r}")
    if not start:
        return records
    positions = F.create_map(*[F.lit(x) for (t, p), o in start.items() for x in (f"{t}\x00{p}", o)])
    here: Column = F.concat(F.col("topic"), F.lit("\x00"), F.col("partition").cast("string"))
    return records.filter(F.col("offset") >= F.coalesce(F.try_element_at(positions, here), F.lit(0)))


def from_offset_table(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """The same from a table ``(topic, partition, offset)``, for resuming on a replica."""
    at = offsets.select("topic", "partition", F.col("offset").alias("_from"))
    kept = lookup_join(records, at, ["topic", "partition"]).filter(
        F.col("offset") >= F.coalesce(F.col("_from"), F.lit(0).cast("bigint"))
    )
    return kept.drop("_from").select(records.columns)
