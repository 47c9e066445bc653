"""Streaming runs (over the tables as file streams), sinks and file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import compare as X
from tidemill.operators.records import decode_cols, regex_filter
from tidemill.operators.registry import frame_records, json_decoder
from tidemill.plans.shared import run_dir
from tidemill.queries.base import ORACLES, READABLE, REC, event_records, micros, query, readable, records_of, table, text
from tidemill.queries.json_queries import stock_lines
from tidemill.queries.registry_queries import registry_of
from tidemill.sources import sinks as S
from tidemill.sources.batches import batch_writer, compact_batches, read_batches
from tidemill.sources.files import read_csv_dir, read_csv_lines, read_json_lines, stream_table
from tidemill.sources.topics import read_topic
from tidemill.streaming import runs as Z
from tidemill.streaming.timers import silence_alerts


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    return stream_table(spark, f"{sf}/events.parquet")


def _dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    base = run_dir(spark, name)
    return f"{base}/out", f"{base}/progress"


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE regexp_matches(value, '\"k\": [0-9]*5\\}}')")
def stream_transform(spark: SparkSession, sf: str) -> DataFrame:
    """A record transform from topic to topic; equal to the batch run."""
    path, progress = _dirs(spark, "transform")
    source = records_of(_events_stream(spark, sf))
    Z.run_transform(source, lambda df: regex_filter(df, r'"k": [0-9]*5\}', True), path, progress).awaitTermination()
    return readable(spark.read.parquet(path))


@query(f"WITH {REC} SELECT {READABLE} FROM rec")
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs with one checkpoint; new input comes between them, and no record is written twice."""
    path, progress = _dirs(spark, "restart")
    arrived = run_dir(spark, "arrivals")
    events = table(spark, sf, "events")
    for rest in range(2):
        events.filter(F.col("event_id") % 2 == rest).write.mode("append").parquet(arrived)
        source = records_of(spark.readStream.schema(events.schema).parquet(arrived))
        Z.run_transform(source, lambda df: df, path, progress).awaitTermination()
    return readable(spark.read.parquet(path))


@query(
    """SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    path, progress = _dirs(spark, "latest")
    source = _events_stream(spark, sf)
    Z.stream_latest(source, ["user_id"], ["ts", "event_id"], path, progress).awaitTermination()
    state = Z.read_latest(spark, path, ["user_id"], ["ts", "event_id"])
    return state.select("event_id", "user_id", "event_type", micros("ts").alias("ts_us"))


@query(
    """SELECT event_id % 500 AS id, epoch_us(max(ts)) AS ts_us, true AS kept
    FROM events GROUP BY 1 HAVING arg_max(event_type, (ts, event_id)) <> 'error'"""
)
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Changes merged batch by batch into a table; an error deletes its row."""
    path, progress = _dirs(spark, "merge")
    events = table(spark, sf, "events")
    arrived = run_dir(spark, "changes")
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    for part in range(3):
        rows = events.filter(F.col("event_id") % 3 == part).withColumns({"id": F.col("event_id") % 500, "op": op})
        rows.write.mode("append").parquet(arrived)
        source = spark.readStream.schema(rows.schema).parquet(arrived)
        merge = Z.merge_changes(path, ["id"], ["ts", "event_id"], every=2)
        run = source.writeStream.foreachBatch(merge).option("checkpointLocation", progress).trigger(**Z.ONCE).start()
        run.awaitTermination()
    state = Z.read_latest(spark, path, ["id"], ["ts", "event_id"])
    return state.filter("op <> 'd'").select("id", micros("ts").alias("ts_us"), F.lit(True).alias("kept"))


@query(
    """SELECT epoch_us(date_trunc('day', ts)) AS day_us, event_type, count(*) AS n FROM events GROUP BY 1, 2"""
)
def stream_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Daily windows, the last open one included."""
    path, progress = _dirs(spark, "throughput")
    source = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    Z.throughput_table(source, "ts", "1 day", "1 hour", path, progress, ["event_type"]).awaitTermination()
    out = Z.read_latest(spark, path, ["period", "event_type"], ["n"])
    return out.select(micros("period").alias("day_us"), "event_type", "n")


@query(
    """WITH e AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events
      WHERE event_type IN ('error', 'purchase')),
    wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm_at FROM events WHERE event_type IN ('error', 'purchase'))
    SELECT user_id, epoch_us(ts) AS last_seen_us, epoch_us(ts + INTERVAL 12 HOUR) AS alert_us FROM e, wm
    WHERE (nxt IS NULL OR nxt >= ts + INTERVAL 12 HOUR) AND date_trunc('millisecond', ts + INTERVAL 12 HOUR) <= wm_at"""
)
def stream_silent_keys(spark: SparkSession, sf: str) -> DataFrame:
    """One alert when a key has been silent for twelve hours."""
    path, progress = _dirs(spark, "silent")
    source = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    important = F.col("event_type").isin("error", "purchase")
    alerts = Z.silent_keys(source, ["user_id"], "ts", "12 hours", "1 hour", important)
    Z.append_query(alerts, path, progress).awaitTermination()
    return spark.read.parquet(path).select(
        "user_id", micros("last_seen").alias("last_seen_us"), micros("alert_at").alias("alert_us")
    )


@query(ORACLES["stream_silent_keys"])
def stream_silence_timers(spark: SparkSession, sf: str) -> DataFrame:
    """The same alerts from event-time timers, over two runs with one checkpoint; new input comes between them."""
    path, progress = _dirs(spark, "timers")
    arrived = run_dir(spark, "arrivals")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    middle = events.agg(F.min("ts") + (F.max("ts") - F.min("ts")) / 2).scalar()
    important = F.col("event_type").isin("error", "purchase")
    for early in (True, False):
        events.filter((F.col("ts") < middle) == early).write.mode("append").parquet(arrived)
        source = spark.readStream.schema(events.schema).parquet(arrived)
        alerts = silence_alerts(source, ["user_id"], "ts", "12 hours", "1 hour", important)
        Z.append_query(alerts, path, progress).awaitTermination()
    return spark.read.parquet(path).select(
        "user_id", micros("last_seen").alias("last_seen_us"), micros("alert_at").alias("alert_us")
    )


@query("SELECT event_id, user_id, epoch_us(ts) AS ts_us FROM events")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Three overlapping polls of a stream, one row per item."""
    path, progress = _dirs(spark, "dedupe")
    polls = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    polls = polls.withColumn("poll", F.explode(F.sequence(F.lit(1), F.lit(3))))
    once = Z.dedupe_stream(polls, ["event_id", "ts"], "ts", "1 day").select("event_id", "user_id", "ts")
    Z.append_query(once, path, progress).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", micros("ts").alias("ts_us"))


@query(
    f"""WITH {REC}, s AS (SELECT topic, part, max(off) + 1 AS e FROM rec GROUP BY 1, 2),
    t AS (SELECT topic, part, max(off) + 1 AS e FROM rec WHERE off % 2 = 0 AND part <> 2 GROUP BY 1, 2)
    SELECT topic, CAST(sum(greatest(s.e - coalesce(t.e, 0), 0)) AS BIGINT) AS lag FROM s LEFT JOIN t USING (topic, part) GROUP BY 1"""
)
def stream_lag(spark: SparkSession, sf: str) -> DataFrame:
    """The gauge after everything has been read."""
    path, progress = _dirs(spark, "lag")
    replica = event_records(spark, sf).filter((F.col("offset") % 2 == 0) & (F.col("partition") != 2))
    source = records_of(_events_stream(spark, sf))
    Z.lag_gauge(source, lambda: X.end_offsets(replica), path, progress).awaitTermination()
    gauge = spark.read.parquet(path)
    last = F.max_by("lag", "batch_id").alias("lag")
    return gauge.groupBy("topic").agg(last)


# -- sinks ---------------------------------------------------------------------------------------


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE topic = 'events-click'")
def topic_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Records written with a topic per record, one topic read back."""
    path = run_dir(spark, "topics")
    S.write_topic(event_records(spark, sf), path, max_records_per_file=1_000_000)
    return readable(read_topic(spark, "events-click", path=path))


@query("SELECT o_orderkey, CAST(o_orderkey % 12 AS INTEGER) AS partition FROM orders")
def assign_partition(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return S.assign_partition(orders, F.col("o_orderkey"), 12).select("o_orderkey", "partition")


@query(f"WITH {REC} SELECT {READABLE} FROM rec")
def land_key_value(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "lake")
    S.land_key_value(event_records(spark, sf), path)
    return readable(decode_cols(spark.read.parquet(path), ["key"]))


@query(f"WITH {REC} SELECT {READABLE} FROM rec")
def land_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Landed batch by batch, some batches twice; most of them compacted; read back through both kinds of folders."""
    path = run_dir(spark, "lake")
    land = batch_writer(path)
    records = event_records(spark, sf).select("key", "value", "topic", "partition", "offset", "timestamp")
    for batch in range(6):
        for _ in range(1 + batch % 2):
            land(records.filter(F.col("offset") % 6 == batch), batch)
        if batch % 2:
            compact_batches(spark, path, batch - 1)
    return readable(decode_cols(read_batches(spark, path), ["key"]))


@query(
    """WITH n AS (SELECT max(s_suppkey) AS top FROM supplier),
    e AS (SELECT event_id, user_id % (top + 3) AS id, event_id % 7 AS odd, props, s_suppkey IS NULL AS unknown
      FROM events, n LEFT JOIN supplier ON s_suppkey = user_id % (top + 3))
    SELECT CAST(id AS INTEGER) AS schema_id, event_id, CAST(CASE WHEN NOT unknown AND odd > 3 THEN props->>'$.k' END AS INTEGER) AS k,
      CASE WHEN unknown THEN 'unknown schema id' WHEN odd < 4 THEN 'payload does not match its schema' END AS error,
      CASE WHEN unknown OR odd < 4 THEN CASE odd WHEN 0 THEN NULL WHEN 1 THEN '{broken' WHEN 2 THEN '{"k":"x"}' WHEN 3 THEN '{"k":1.5}' ELSE props END END AS body
    FROM e"""
)
def land_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Framed records of every supplier's schema landed and read back, rejects with their body."""
    suppliers = table(spark, sf, "supplier")
    top = suppliers.agg(F.max("s_suppkey").alias("top"))
    e = table(spark, sf, "events").join(F.broadcast(top))  # one row
    odd = F.col("event_id") % 7
    body = F.when(odd == 1, "{broken").when(odd == 2, '{"k":"x"}').when(odd == 3, '{"k":1.5}').when(odd > 3, F.col("props"))
    sid = F.col("user_id") % (F.col("top") + 3)
    rows = e.select("event_id", sid.cast("int").alias("sid"), body.cast("binary").alias("value"))
    path = run_dir(spark, "typed")
    empty = F.when(F.col("value").isNull(), F.lit(b""))
    framed = frame_records(rows.withColumn("value", F.coalesce("value", empty)), F.col("sid")).drop("sid")
    S.land_typed(framed, registry_of(suppliers), path)
    # all schemas here have the field k; one of them types its own folders, the rest are read alike
    landed = spark.read.parquet(path).filter(F.col(S.LANDED) != S.REJECTED)
    good = landed.select("schema_id", "event_id", json_decoder(F.col("value"), _K_SCHEMA)["k"].alias("k"))
    none = F.lit(None).cast("string")
    good = good.withColumn("error", none).withColumn("body", none)
    bad = S.read_rejected(spark, path).select(
        "schema_id", "event_id", F.lit(None).cast("int").alias("k"), F.col("_error").alias("error"),
        F.nullif(F.col("value").cast("string"), F.lit("")).alias("body"),
    )
    return good.unionByName(bad)


_NESTED = (
    '{"type":"record","name":"R","fields":[{"name":"a","type":{"type":"record","name":"A","fields":[{"name":"x","type":"int"}]}},'
    '{"name":"l","type":{"type":"array","items":"long"}},{"name":"e","type":{"type":"enum","name":"E","symbols":[SYMBOLS]}},'
    '{"name":"m","type":{"type":"map","values":"A"},"default":{}}]}'
)


@query(
    """WITH e AS (SELECT event_id, user_id, event_type, s_suppkey, event_id % 8 AS odd,
        CASE WHEN s_suppkey % 2 = 0 THEN event_type IN ('click', 'view') ELSE event_type <> 'view' END AS known,
        '{"a":{' || CASE event_id % 8 WHEN 1 THEN '"x":"bad"' WHEN 2 THEN '' ELSE '"x":' || user_id END || '},"l":[' || event_id
          || CASE event_id % 8 WHEN 3 THEN ',"q"' WHEN 4 THEN ',null' ELSE ',7' END || '],"e":"' || event_type || '"'
          || CASE event_id % 8 WHEN 5 THEN ',"m":{"k":{"x":1},"n":{}}' WHEN 6 THEN ',"m":{"k":{"x":1}}' ELSE '' END || '}' AS body
      FROM events JOIN supplier ON s_suppkey = user_id % (SELECT max(s_suppkey) FROM supplier) + 1)
    SELECT CAST(s_suppkey AS INTEGER) AS schema_id, event_id, CAST(CASE WHEN good THEN user_id END AS INTEGER) AS x, CASE WHEN good THEN event_id + 7 END AS total,
      CASE WHEN good THEN event_type END AS e, CASE WHEN good AND odd = 6 THEN 1 END AS k, CASE WHEN NOT good THEN 'payload does not match its schema' END AS error,
      CASE WHEN NOT good THEN body END AS body FROM (SELECT *, known AND odd NOT IN (1, 2, 3, 4, 5) AS good FROM e)"""
)
def land_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records, arrays, maps and enums, one schema per supplier, landed, read back and rejected with their body."""
    suppliers = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    even, odd_ones = (_NESTED.replace("SYMBOLS", x) for x in ('"click","view"', '"signup","click","error","purchase"'))
    registry = suppliers.select(
        text("t", key).alias("subject"), F.lit(1).alias("version"), key.cast("int").alias("id"), F.lit("AVRO").alias("format"),
        F.when(key % 2 == 0, even).otherwise(odd_ones).alias("schema"),
    )
    event, case = F.col("event_id"), F.col("event_id") % 8
    body = text(
        '{"a":{', F.when(case == 1, '"x":"bad"').when(case == 2, "").otherwise(text('"x":', F.col("user_id"))), '},"l":[', event,
        F.when(case == 3, ',"q"').when(case == 4, ",null").otherwise(",7"), '],"e":"', F.col("event_type"), '"',
        F.when(case == 5, ',"m":{"k":{"x":1},"n":{}}').when(case == 6, ',"m":{"k":{"x":1}}').otherwise(""), "}",
    )
    most = suppliers.agg(F.max("s_suppkey").alias("most"))
    sid = (F.col("user_id") % most.scalar() + 1).cast("int")
    rows = table(spark, sf, "events").select("event_id", sid.alias("sid"), body.cast("binary").alias("value"))
    path = run_dir(spark, "nested")
    S.land_typed(frame_records(rows, F.col("sid")).drop("sid"), registry, path)
    landed = spark.read.parquet(path).filter(F.col(S.LANDED) != S.REJECTED)
    # both schemas give the same columns
    read = landed.select("schema_id", "event_id", json_decoder(F.col("value"), _NESTED.replace("SYMBOLS", '"click","view","signup","error","purchase"')).alias("p"))
    none = F.lit(None).cast("string")
    good = read.select(
        "schema_id", "event_id", F.col("p.a.x").alias("x"), F.aggregate("p.l", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"),
        F.col("p.e").alias("e"), F.col("p.m")["k"]["x"].alias("k"), none.alias("error"), none.alias("body"),
    )
    bad = S.read_rejected(spark, path).select("schema_id", "event_id", F.col("_error").alias("error"), F.col("value").cast("string").alias("body"))
    return good.unionByName(bad, allowMissingColumns=True)


_K_SCHEMA = '{"type":"record","name":"K","fields":[{"name":"k","type":"int"}]}'


@query(f"WITH {REC} SELECT {READABLE} FROM rec")
def replicate_files(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "replica")
    S.replicate(event_records(spark, sf), path)
    return readable(spark.read.parquet(path))


# -- file scans ----------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of CSV files with headers."""
    path = run_dir(spark, "csv")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders.write.option("header", True).csv(path)
    return read_csv_dir(spark, path, orders.schema)


@query(
    """SELECT strftime(o_orderdate, '%m/%d/%Y') || ',$' || o_totalprice || ',' || o_custkey || ',$' || o_totalprice || ',$'
    || o_totalprice || ',$' || o_totalprice AS value FROM orders"""
)
def csv_raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """CSV lines as raw text, the header of every file left out."""
    path = run_dir(spark, "lines")
    lines = stock_lines(table(spark, sf, "orders")).select(F.col("value").alias("Date,Close/Last,Volume,Open,High,Low"))
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    return read_csv_lines(spark, path)


@query("SELECT event_id, user_id, event_type FROM events")
def json_line_files(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "json")
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    rows.write.json(path)
    return read_json_lines(spark, path, rows.schema)

