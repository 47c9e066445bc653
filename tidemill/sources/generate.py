"""Seeded load generators: rows come from ``range`` and hashes, never from the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.records import to_records

# --- fixed values -----------------------------------------------------------------------
CLICK_USERS = 100
CLICK_EVENT = "navigation"
#: topic -> (messages per batch, partitions)
DEMO_TOPICS = {"demo-orders": (50, 12), "demo-user-state": (10, 6), "demo-events": (16, 8), "demo-alerts": (5, 3)}
ORDERS_PER_BATCH = DEMO_TOPICS["demo-orders"][0]
CUSTOMERS, USERS, EVENT_TYPES = 1000, 100, 10
# ----------------------------------------------------------------------------------------


def _draw(seed: int, n: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(n))


def _uuid(seed: int, *cols: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _clicks(ids: DataFrame, seed: int, start_micros: int) -> DataFrame:
    seq = F.col("seq")
    return ids.select(
        F.struct(_uuid(seed, seq).alias("uuid"), seq.cast("int").alias("seq")).alias("key"),
        F.struct(
            (_draw(seed, CLICK_USERS, seq) + 1).cast("int").alias("user_id"),
            F.lit(CLICK_EVENT).alias("event_type"),
            (F.lit(start_micros) + seq).alias("ts_millis"),
        ).alias("value"),
    )


def gen_clicks(spark: SparkSession, n: int = 10_000, seed: int = 0, start_micros: int = 0) -> DataFrame:
    """``n`` clicks: key (uuid, seq from 0), value (user 1..100, ``navigation``, a time)."""
    return _clicks(spark.range(n).withColumnRenamed("id", "seq"), seed, start_micros)


def stream_clicks(spark: SparkSession, rows_per_second: int = 10, seed: int = 0) -> DataFrame:
    """The same as an endless stream."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return _clicks(ticks.withColumnRenamed("value", "seq"), seed, 0)


def gen_demo_topics(spark: SparkSession, batches: int, seed: int = 0, start_seconds: int = 0) -> DataFrame:
    """Records of four topics, 81 per batch.

    The partition is a counter modulo the topic's partitions, so that a user's states lie
    in several partitions.  Offsets count up within a partition.
    """
    parts = []
    b, i = F.col("batch"), F.col("i")
    at = F.lit(start_seconds) + b * 2
    for topic, (per_batch, n_partitions) in DEMO_TOPICS.items():
        rows = spark.range(batches * per_batch).select(
            F.expr(f"id div {per_batch}").alias("batch"), (F.col("id") % per_batch).alias("i"), "id"
        )
        number = b * ORDERS_PER_BATCH + i if topic == "demo-orders" else (b + 1) * ORDERS_PER_BATCH
        counter = number if topic == "demo-orders" else i + 1
        numbered = F.lpad(number.cast("string"), 6, "0")
        if topic == "demo-orders":
            key = F.concat(F.lit("order-"), numbered)
            cents = _draw(seed, 100_000, b, i)
            body = F.struct(
                key.alias("order_id"),
                F.concat(F.lit("customer-"), _draw(seed + 1, CUSTOMERS, b, i)).alias("customer_id"),
                (cents / 100).alias("amount"),
                at.alias("timestamp"),
            )
        elif topic == "demo-user-state":
            key = F.concat(F.lit("user-"), _draw(seed + 2, USERS, b, i))
            body = F.struct(key.alias("user_id"), F.lit("active").alias("state"), at.alias("updated_at"))
        elif topic == "demo-events":
            key = F.concat(F.lit("type-"), _draw(seed + 3, EVENT_TYPES, b, i))
            body = F.struct(
                F.concat(F.lit("event-"), numbered).alias("event_id"), key.alias("type"), at.alias("timestamp")
            )
        else:
            key = F.concat(F.lit("alert-"), numbered)
            body = F.struct(key.alias("alert_id"), F.lit("info").alias("severity"), at.alias("timestamp"))
        parts.append(
            to_records(
                rows,
                topic,
                F.to_json(body),
                key,
                F.pmod(counter, F.lit(n_partitions)),
                # the counter repeats per batch: earlier batches' hits plus those of this one
                _offset(topic, counter, per_batch, n_partitions),
                F.timestamp_seconds(at),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _offset(topic: str, counter: Column, per_batch: int, n: int) -> Column:
    if topic == "demo-orders":
        return F.floor(counter / n)
    hits = F.create_map(
        *[x for p in range(n) for x in (F.lit(p), F.lit(sum(1 for j in range(1, per_batch + 1) if j % n == p)))]
    )
    here = F.pmod(counter, F.lit(n)).cast("int")
    first = F.when(here == 0, F.lit(n)).otherwise(here)
    return F.col("batch") * F.element_at(hits, here) + F.floor((counter - first) / n)
