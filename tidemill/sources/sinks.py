"""Sinks for records, lake tables and vector rows, batch or streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.documents import document_rows
from tidemill.operators.limits import offset_order
from tidemill.operators.registry import check_bodies, json_decoder, unframe_records
from tidemill.sources.batches import batch_writer
from tidemill.sources.topics import has_kafka

# --- fixed values: commit cadence -------------------------------------------------------
BATCH_INTERVAL = "1 second"
LAKE_COMMIT_INTERVAL = "5 seconds"
# ----------------------------------------------------------------------------------------
#: the folder column of landed records, its value for rejects, and the folders of good records at most
LANDED = "landed"
REJECTED = -1
FOLDERS = 256


def assign_partition(df: DataFrame, number: Column, partitions: int) -> DataFrame:
    """Explicit partition: ``number`` modulo the partition count."""
    return df.withColumn("partition", F.pmod(number, F.lit(partitions)).cast("int"))


def write_topic(
    df: DataFrame,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    max_records_per_file: int = 0,
) -> StreamingQuery | None:
    """Produce records; the ``topic`` column decides where each goes unless one is named.

    A batch frame returns when everything is written.  A stream needs a checkpoint, which
    makes the parquet sink exactly-once, and returns the running query.
    """
    out = df if topic is None else df.withColumn("topic", F.lit(topic))
    if servers is not None and not has_kafka(df.sparkSession):
        raise RuntimeError("the Kafka connector is not on the class path")
    if df.isStreaming and checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = out.writeStream if df.isStreaming else out.write
    if servers is not None:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
    elif path is not None:
        writer = writer.format("parquet").option("path", path).partitionBy("topic")
        writer = writer.option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file)
    else:
        raise ValueError("give servers or a path")
    if not df.isStreaming:
        (writer if servers is not None else writer.mode("append")).save()
        return None
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))
        .start()
    )


def land_key_value(
    df: DataFrame, path: str, checkpoint: str | None = None, trigger: Mapping | None = None
) -> StreamingQuery | None:
    """Land records as they are: key and value bytes plus topic, partition, offset, time.

    A stream lands one folder per batch, which a repeated batch replaces, and commits at the
    lake's interval unless another trigger is given; ``sources.batches`` compacts and reads them.
    """
    kept = df.select("key", "value", "topic", "partition", "offset", "timestamp", "headers")
    if not df.isStreaming:
        kept.write.mode("append").parquet(path)
        return None
    return _each_batch(kept, batch_writer(path), checkpoint, trigger)


def _each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], object], checkpoint: str | None, trigger: Mapping | None
) -> StreamingQuery:
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")

    def land(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)

    writer = df.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": LAKE_COMMIT_INTERVAL})).start()


def land_typed(df: DataFrame, registry: DataFrame, path: str, mode: str = "append") -> None:
    """Land framed records by their schema, in one pass and for a registry of any size.

    Each body is checked against its schema where it is read (:func:`check_bodies`), and
    everything is written once: good bodies to the folder of their schema id (modulo :data:`FOLDERS`, so that a large registry
    does not make as many folders), rejects with message and body to the folder :data:`REJECTED`.  :func:`read_landed`
    types a schema's bodies.

    Rows are dealt out by folder before they are written: a folder gets a file, or as many as adaptive execution
    makes of a large one.  In a file the rows of a schema lie together.
    """
    unframed = unframe_records(df, on_error="reject")
    checked = check_bodies(unframed, registry)
    folder = F.when(F.col("_error").isNull(), _folder(F.col("schema_id"))).otherwise(REJECTED)
    # a rebalancing exchange: small folders share a task, a large one is split by size
    dealt = checked.withColumn(LANDED, folder).hint("rebalance", LANDED).sortWithinPartitions(LANDED, "schema_id")
    dealt.write.mode(mode).partitionBy(LANDED).parquet(path)


def _folder(schema_id: Column) -> Column:
    return F.pmod(schema_id, F.lit(FOLDERS))


def read_landed(
    spark: SparkSession,
    path: str,
    schema_id: int,
    schema: str,
    decoder: Callable[[Column, str], Column] = json_decoder,
    column: str = "value",
) -> DataFrame:
    """The records of one schema with typed columns; only the folders that may hold them are read."""
    rows = spark.read.parquet(path).filter((F.col(LANDED) == _folder(F.lit(schema_id))) & (F.col("schema_id") == schema_id))
    typed = rows.withColumn("_p", decoder(F.col(column), schema))
    meta = [c for c in rows.columns if c not in (column, "schema_id", "_error", LANDED, "batch_id")]
    return typed.select(*meta, "_p.*")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """What could not be landed, with message and body."""
    return spark.read.parquet(path).filter(F.col(LANDED) == REJECTED).drop(LANDED, "batch_id")


def land_typed_stream(
    df: DataFrame, registry: DataFrame, path: str, checkpoint: str | None, trigger: Mapping | None = None
) -> StreamingQuery:
    """:func:`land_typed` for a stream: one sub-folder per batch, which a repeated batch replaces."""

    def write(batch: DataFrame, batch_id: int) -> None:
        land_typed(batch, registry, f"{path}/batch_id={batch_id}", "overwrite")

    return _each_batch(df, write, checkpoint, trigger)


def write_vectors(
    df: DataFrame, path: str, text: str = "text", metadata: str = "metadata", embedding: str = "embedding"
) -> None:
    """Append one text/metadata/embedding row per message."""
    row = document_rows(F.col(text), F.col(metadata), F.col(embedding)).alias("d")
    df.select(row).select("d.*").write.mode("append").parquet(path)


def replicate(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Copy records so that each file holds a run of offsets in order."""
    offset_order(df, partitions).write.mode("append").parquet(path)
