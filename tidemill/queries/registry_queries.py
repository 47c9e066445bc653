"""Frames and the schema table (derived from suppliers: one schema version per supplier)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import registry as G
from tidemill.operators.records import project_json
from tidemill.queries.base import query, table, text

_REG = """
reg AS (
  SELECT 'topic-' || (s_suppkey % 20) || '-value' AS subject, CAST(s_suppkey // 20 + 1 AS INTEGER) AS version,
    CAST(s_suppkey AS INTEGER) AS id, 'AVRO' AS format,
    '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"nation' || s_nationkey
      || '","type":"string","default":""}]}' AS schema
  FROM supplier)
"""


def registry_of(suppliers: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return suppliers.select(
        text("topic-", key % 20, "-value").alias("subject"),
        (F.expr("s_suppkey div 20") + 1).cast("int").alias("version"),
        key.cast("int").alias("id"),
        F.lit("AVRO").alias("format"),
        text(
            '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"nation',
            F.col("s_nationkey"),
            '","type":"string","default":""}]}',
        ).alias("schema"),
    )


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return registry_of(table(spark, sf, "supplier"))


def _framed(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    rows = e.select("event_id", F.col("props").cast("binary").alias("value"))
    return G.frame_records(rows, (F.col("event_id") % 130).cast("int"))


@query(
    """SELECT event_id, '00' || lpad(hex(event_id % 130), 8, '0') || hex(encode(props)) AS frame,
    CAST(event_id % 130 AS INTEGER) AS schema_id, props AS body FROM events"""
)
def frame_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = _framed(spark, sf).withColumn("frame", F.hex("value"))
    out = G.unframe_records(rows, on_error="drop")
    return out.select("event_id", "frame", "schema_id", F.col("value").cast("string").alias("body"))


@query(
    """SELECT CASE event_id % 3 WHEN 0 THEN 'frame too short' WHEN 1 THEN 'bad magic byte' END AS error,
    count(*) AS n, count(CASE WHEN event_id % 3 = 2 THEN 1 END) AS framed FROM events GROUP BY 1"""
)
def frame_errors(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id") % 3
    rows = _framed(spark, sf)
    broken = F.when(k == 0, F.substring("value", 1, 4)).when(k == 1, F.concat(F.unhex(F.lit("FF")), F.col("value"))).otherwise(
        F.col("value")
    )
    out = G.unframe_records(rows.withColumn("value", broken))
    return out.groupBy(F.col("_error").alias("error")).agg(F.count(F.lit(1)).alias("n"), F.count("schema_id").alias("framed"))


@query(
    f"""WITH {_REG} SELECT event_id, CAST(event_id % 130 AS INTEGER) AS schema_id, schema, format,
    CASE WHEN id IS NULL THEN 'unknown schema id' END AS error FROM events LEFT JOIN reg ON id = event_id % 130"""
)
def schema_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.unframe_records(_framed(spark, sf), on_error="drop")
    out = G.with_schema(rows, _registry(spark, sf)).withColumnRenamed("_error", "error")
    return out.select("event_id", "schema_id", "schema", "format", "error")


@query(
    f"""WITH {_REG} SELECT subject, version, id, format, schema FROM reg
    QUALIFY row_number() OVER (PARTITION BY subject ORDER BY version DESC) = 1"""
)
def latest_schema(spark: SparkSession, sf: str) -> DataFrame:
    return G.latest_schema(_registry(spark, sf))


@query(
    f"""WITH {_REG}, new AS (SELECT 'topic-' || (s_suppkey + 15) || '-value' AS subject, 1 AS version,
      CAST(s_suppkey + 1000 AS INTEGER) AS id, 'AVRO' AS format, '"long"' AS schema FROM supplier)
    SELECT * FROM reg UNION ALL SELECT * FROM new WHERE subject NOT IN (SELECT subject FROM reg)"""
)
def register_schema(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    new = table(spark, sf, "supplier").select(
        text("topic-", key + 15, "-value").alias("subject"),
        F.lit(1).alias("version"),
        (key + 1000).cast("int").alias("id"),
        F.lit("AVRO").alias("format"),
        F.lit('"long"').alias("schema"),
    )
    return G.register_schema(_registry(spark, sf), new)


@query(f"WITH {_REG} SELECT * FROM reg")
def sync_registry(spark: SparkSession, sf: str) -> DataFrame:
    """A target that lacks the newer versions becomes equal to its source, ids kept."""
    source = _registry(spark, sf)
    return G.sync_registry(source, source.filter(F.col("version") <= 2))


@query(
    """WITH one AS (SELECT s_suppkey, s_nationkey,
      'topic-' || s_suppkey || '-value' AS subject FROM supplier)
    SELECT subject, CAST(CASE WHEN s_suppkey % 6 IN (1, 3, 5) THEN 1 ELSE 0 END AS BIGINT) AS n_problems,
    s_suppkey % 2 = 0 AS compatible FROM one"""
)
def backward_compatible(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier: a wider type; a new field without default; a removed field and a new one with default; a
    changed type; a type that became one of a union; a union that became one of its types."""
    k = F.col("s_suppkey")
    subject = text("topic-", k, "-value").alias("subject")
    old = '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"s","type":"string"}]}'
    news = {
        0: '{"type":"record","name":"R","fields":[{"name":"k","type":"long"},{"name":"s","type":"string"}]}',
        1: '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"s","type":"string"},{"name":"n","type":"int"}]}',
        2: '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"n","type":["null","int"],"default":null}]}',
        3: '{"type":"record","name":"R","fields":[{"name":"k","type":"boolean"},{"name":"s","type":"string"}]}',
        4: '{"type":"record","name":"R","fields":[{"name":"k","type":["null","int"]},{"name":"s","type":["null","string"]}]}',
        5: '{"type":"record","name":"R","fields":[{"name":"k","type":"int"},{"name":"s","type":"string"}]}',
    }
    new = F
    for n, schema in news.items():
        new = new.when(k % 6 == n, schema)
    old = F.when(k % 6 == 5, '{"type":"record","name":"R","fields":[{"name":"k","type":["null","int"]},{"name":"s","type":"string"}]}').otherwise(old)
    s = table(spark, sf, "supplier")
    before = s.select(subject, F.lit(1).alias("version"), old.alias("schema"))
    after = s.select(subject, F.lit(2).alias("version"), new.alias("schema"))
    return G.backward_compatible(G.schema_fields(before), G.schema_fields(after))


@query(
    """SELECT event_id, CASE WHEN event_id % 11 < 3 THEN NULL WHEN event_id % 3 = 0 THEN -1 ELSE CAST(user_id AS INTEGER) END AS user_id,
    CASE WHEN event_id % 11 < 3 THEN NULL WHEN event_id % 3 = 1 THEN 'unknown' ELSE event_type END AS event_type,
    CASE WHEN event_id % 11 < 3 THEN NULL WHEN event_id % 3 = 2 THEN -1 ELSE epoch_us(ts) END AS ts_millis,
    CASE event_id % 11 WHEN 0 THEN 'not a click' WHEN 1 THEN 'not a click' WHEN 2 THEN 'missing value' END AS error FROM events"""
)
def decode_click(spark: SparkSession, sf: str) -> DataFrame:
    """JSON clicks, each lacking one field; some are malformed, mistyped or missing."""
    k = F.col("event_id") % 3
    body = F.to_json(
        F.struct(
            F.when(k != 0, F.col("user_id")).alias("user_id"),
            F.when(k != 1, F.col("event_type")).alias("event_type"),
            F.when(k != 2, F.unix_micros(F.col("ts").cast("timestamp"))).alias("ts_millis"),
        )
    )
    odd = F.col("event_id") % 11
    body = F.when(odd == 0, "{broken").when(odd == 1, '{"user_id":"x"}').when(odd > 2, body)
    rows = table(spark, sf, "events").select("event_id", body.alias("value"))
    return G.decode_click(rows).drop("value").withColumnRenamed("_error", "error")


@query(
    """SELECT CAST(event_id % 3 AS INTEGER) AS schema_id,
    CAST(CASE WHEN event_id % 3 < 2 AND event_id % 5 > 1 THEN props->>'$.k' END AS INTEGER) AS k,
    CASE WHEN event_id % 3 = 2 THEN 'unknown schema id' WHEN event_id % 5 < 2 THEN 'payload does not match its schema' END AS error,
    count(*) AS n, coalesce(sum(CASE WHEN event_id % 3 = 2 OR event_id % 5 < 2 THEN
      CASE event_id % 5 WHEN 0 THEN 7 WHEN 1 THEN 9 ELSE length(props) END END), 0)::BIGINT AS bytes FROM events GROUP BY ALL"""
)
def decode_by_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows per schema, for a registry of two; some bodies are malformed or mistyped, and rejects keep them."""
    e = table(spark, sf, "events")
    odd = F.col("event_id") % 5
    body = F.when(odd == 0, "{broken").when(odd == 1, '{"k":"x"}').otherwise(F.col("props"))
    rows = G.frame_records(e.select("event_id", body.cast("binary").alias("value")), (F.col("event_id") % 3).cast("int"))
    registry = registry_of(table(spark, sf, "supplier").filter(F.col("s_suppkey") < 2))
    frames = G.decode_by_schema(rows, registry)
    none = F.lit(None).cast("string").alias("error")
    parts = [f.select(F.lit(sid).alias("schema_id"), "k", none, F.lit(0).alias("b")) for sid, f in frames.items() if sid != -1]
    bad = frames[-1].select("schema_id", F.lit(None).cast("int").alias("k"), F.col("_error").alias("error"), F.octet_length("value").alias("b"))
    out = bad
    for p in parts:
        out = out.unionByName(p)
    return out.groupBy("schema_id", "k", "error").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("bytes"))


@query(
    """SELECT event_id, '0000000007' || hex(encode('{"latitude":' || CAST(CAST(user_id || '.' || (event_id % 100) AS DOUBLE) AS VARCHAR)
    || ',"timestamp":' || (epoch_us(ts) // 1000000) || '}')) AS frame FROM events WHERE event_id % 7 <> 0"""
)
def framed_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON to typed rows to framed payloads; unreadable positions are dropped."""
    lat = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(text(F.col("user_id"), ".", F.col("event_id") % 100))
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    value = text('{"timestamp":', at, ',"position":{"latitude":"', lat, '"}}')
    rows = table(spark, sf, "events").withColumn("value", value)
    fields = {"latitude": ("position.latitude", "double"), "timestamp": ("timestamp", "int")}
    typed = project_json(rows, fields, keep=["event_id"], on_error="drop")
    schema = '{"type":"record","name":"P","fields":[{"name":"latitude","type":"double"},{"name":"timestamp","type":"int"}]}'
    framed = G.frame_records(G.encode_rows(typed, schema), 7)
    return framed.select("event_id", F.hex("value").alias("frame"))


@query(
    """SELECT event_id, '000000000' || (event_id % 5) || CASE event_id % 5 WHEN 0 THEN '00' WHEN 1 THEN '0202' WHEN 2 THEN '040004'
      WHEN 3 THEN '048001808001' ELSE '06060002' END || hex(encode(props)) AS frame,
    CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '0,2' WHEN 3 THEN '64,8192' ELSE '3,0,1' END AS indexes, props AS body FROM events"""
)
def framed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of nested Protobuf messages framed with their message indexes and read back."""
    case = F.col("event_id") % 5
    lists = [[0], [1], [0, 2], [64, 8192], [3, 0, 1]]
    indexes = F.get(F.array(*[F.lit(x) for x in lists]), case.cast("int"))
    rows = table(spark, sf, "events").select("event_id", "props", F.col("props").cast("binary").alias("value"))
    framed = G.frame_messages(rows, case.cast("int"), indexes).withColumn("frame", F.hex("value"))
    out = G.unframe_messages(framed, on_error="drop")
    read = F.array_join(out["message_indexes"].cast("array<string>"), ",").alias("indexes")
    return out.select("event_id", "frame", read, F.col("value").cast("string").alias("body"))


@query(
    """SELECT 't' || s_suppkey AS subject, CASE s_suppkey % 8 WHEN 0 THEN 'a.x' WHEN 1 THEN 'a.y' WHEN 2 THEN 'l[]' WHEN 3 THEN 'm{}.x' WHEN 4 THEN 'e' END AS path,
    CASE s_suppkey % 8 WHEN 0 THEN 'long cannot be read as int' WHEN 1 THEN 'new field without a default' WHEN 2 THEN 'null cannot be read as long'
      WHEN 3 THEN 'int cannot be read as string' WHEN 4 THEN 'unknown symbols n' || s_nationkey END AS problem FROM supplier WHERE s_suppkey % 8 < 5"""
)
def nested_compatibility(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier one nested change: narrower, new without a default, no longer null, another type, a symbol less; and
    a wider type, an alias and a new branch, which are no problems."""
    parts = {n: f'{{"type":"record","name":"{n}","fields":[{{"name":"x","type":"int"}}]}}' for n in ("A", "M")}

    def schema(a: str, items: str, values: str, symbols: Column, name: str = '"l"') -> Column:
        return text(
            '{"type":"record","name":"R","fields":[{"name":"a","type":', a, '},{"name":', name, ',"type":{"type":"array","items":', items,
            '}},{"name":"m","type":{"type":"map","values":', values, '}},{"name":"e","type":{"type":"enum","name":"E","symbols":', symbols, "}}]}",
        )

    own = text('["old","n', F.col("s_nationkey"), '"]')
    wide, more = parts["A"].replace('"int"', '"long"'), parts["A"].replace("]}", ',{"name":"y","type":"int"}]}')
    changes = {
        0: (schema(wide, '"long"', parts["M"], own), schema(parts["A"], '"long"', parts["M"], own)),
        1: (schema(parts["A"], '"long"', parts["M"], own), schema(more, '"long"', parts["M"], own)),
        2: (schema(parts["A"], '["null","long"]', parts["M"], own), schema(parts["A"], '"long"', parts["M"], own)),
        3: (schema(parts["A"], '"long"', parts["M"], own), schema(parts["A"], '"long"', parts["M"].replace('"int"', '"string"'), own)),
        4: (schema(parts["A"], '"long"', parts["M"], own), schema(parts["A"], '"long"', parts["M"], F.lit('["old"]'))),
        5: (schema(parts["A"], '"long"', parts["M"], own), schema(wide, '"long"', parts["M"], own)),
        6: (schema(parts["A"], '"long"', parts["M"], own), schema(parts["A"], '"long"', parts["M"], own, '"k","aliases":["l"]')),
        7: (schema(parts["A"], '"long"', parts["M"], own), schema(parts["A"], '["null","long"]', parts["M"], own)),
    }
    k = F.col("s_suppkey")
    pick = lambda side: F.coalesce(*[F.when(k % 8 == n, pair[side]) for n, pair in changes.items()]).alias("schema")
    s = table(spark, sf, "supplier")
    old, new = (s.select(text("t", k).alias("subject"), pick(side)) for side in (0, 1))
    return G.compatibility_problems(old, new)
