"""Running the operators on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.compare import end_offsets
from tidemill.operators.keyed import latest_by_key
from tidemill.sources.batches import batch_writer, compact_batches, read_batches

ONCE = {"availableNow": True}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(df: DataFrame) -> None:
    """Keep stream state off the heap."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_transform(
    source: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: Mapping = ONCE,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Apply a narrow operator to a stream and append the result as parquet.

    Progress is committed with the checkpoint after the files are in place: a restart goes
    on where the last run stopped and no record is written twice.
    """
    writer = operator(source).writeStream.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def keep_latest(path: str, keys: Sequence[str], order: Sequence[str], every: int = 20) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the last row per key of each batch goes to the batch's folder, and every ``every`` batches
    those before are compacted to one row per key.  :func:`read_latest` is the table.

    No state is kept between batches: a row that comes late loses against the newer one when the table is read.
    """
    land = batch_writer(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        land(latest_by_key(batch, keys, order, reread=False), batch_id)
        if (batch_id + 1) % every == 0:
            compact_batches(batch.sparkSession, path, batch_id, lambda rows: latest_by_key(rows, keys, order, reread=False))

    return write


def _into(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping, mode: str) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_latest(
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    path: str,
    checkpoint: str,
    trigger: Mapping = ONCE,
    every: int = 20,
) -> StreamingQuery:
    """Keep the latest row per key of a stream (:func:`keep_latest`); read it with :func:`read_latest`."""
    return _into(source, keep_latest(path, keys, order, every), checkpoint, trigger, "append")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current rows of a table that :func:`keep_latest` writes."""
    return latest_by_key(read_batches(spark, path), keys, order, reread=False)


def throughput_table(
    source: DataFrame,
    time_col: str,
    period: str,
    lateness: str,
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    trigger: Mapping = ONCE,
) -> StreamingQuery:
    """Rows per period, open ones included, in a table by period; read it with
    :func:`read_latest`, keys ``period`` and ``by``, order ``n`` (counts only grow)."""
    use_rocksdb(source)
    counted = throughput_windows(source, time_col, period, lateness, by)
    return _into(counted, keep_latest(path, ["period", *by], ["n"]), checkpoint, trigger, "update")


def throughput_windows(
    source: DataFrame, time_col: str, period: str, lateness: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per tumbling period; rows later than ``lateness`` are left out.  Appended when a
    period is closed; :func:`throughput_table` has the open ones too."""
    counted = (
        source.withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, period), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.col("window.start").alias("period"), *by, "n")


def silent_keys(
    source: DataFrame, keys: Sequence[str], time_col: str, silence: str, lateness: str, important: Column | None = None
) -> DataFrame:
    """One alert per key and silence: no row for ``silence`` after ``last_seen``.

    Session windows close exactly then; sessions are merged within a task first, so
    a busy key sends few rows.
    """
    rows = source if important is None else source.filter(important)
    sessions = (
        rows.withWatermark(time_col, lateness)
        .groupBy(F.session_window(time_col, silence), *keys)
        .agg(F.max(time_col).alias("last_seen"), F.count(F.lit(1)).alias("n"))
    )
    return sessions.select(*keys, "last_seen", F.col("session_window.end").alias("alert_at"), "n")


def dedupe_stream(
    source: DataFrame, keys: Sequence[str], time_col: str, lateness: str, salts: int = 8
) -> DataFrame:
    """One row per key within the watermark; older keys are forgotten.

    Copies are first reduced per salt, so that the copies of one key spread over up to
    ``salts`` tasks, and what is left per key.  ``salts=1`` leaves the first step out.
    """
    rows = source.withWatermark(time_col, lateness)
    if salts > 1:
        salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        rows = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(list(keys))


def append_query(df: DataFrame, path: str, checkpoint: str, trigger: Mapping = ONCE) -> StreamingQuery:
    """Append a stream's closed results as parquet."""
    use_rocksdb(df)
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def lag_gauge(
    source: DataFrame,
    target: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    trigger: Mapping = ONCE,
) -> StreamingQuery:
    """Write, per micro-batch, how far the target is behind each topic of the source.

    ``target`` returns the replica's end offsets (topic, partition, end_offset) as of now.
    """
    use_rocksdb(source)

    def measure(batch: DataFrame, batch_id: int) -> None:
        there = target().withColumnRenamed("end_offset", "_there")
        both = batch.join(there, ["topic", "partition"], "left")
        behind = F.col("end_offset") - F.coalesce(F.col("_there"), F.lit(0).cast("bigint"))
        lag = both.groupBy("topic").agg(F.sum(F.greatest(behind, F.lit(0).cast("bigint"))).alias("lag"))
        lag.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        end_offsets(source)  # one state row per topic partition, so the whole gauge is small
        .writeStream.outputMode("complete")
        .foreachBatch(measure)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def query_lag(query: StreamingQuery) -> dict[str, float]:
    """A running query's own lag: rows read, rows processed per second, and what the source
    reports as being behind (Kafka's ``maxOffsetsBehindLatest``), from its last progress."""
    last = query.lastProgress
    if last is None:
        return {}
    out = {"input_rows": float(last["numInputRows"]), "rows_per_second": float(last["processedRowsPerSecond"] or 0)}
    behind = [float(s["metrics"]["maxOffsetsBehindLatest"]) for s in last["sources"]
              if "maxOffsetsBehindLatest" in (s.get("metrics") or {})]
    if behind:
        out["offsets_behind"] = max(behind)
    return out


def merge_changes(path: str, keys: Sequence[str], order: Sequence[str], every: int = 20) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a batch of changes (:func:`keep_latest`);
    ``operators.keyed.current_rows`` over :func:`read_latest` is the table.  Deleted rows stay as the last
    change of their key, so that a change that comes late does not bring them back."""
    return keep_latest(path, keys, order, every)
