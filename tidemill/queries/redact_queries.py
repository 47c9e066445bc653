"""Redaction and timestamp conversion."""

from __future__ import annotations

import base64
import gzip
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.instants import normalise_epoch
from tidemill.functions.redaction import bind, register_function
from tidemill.operators.documents import mask_emails_in
from tidemill.operators.redact import redact
from tidemill.operators.timestamps import convert_ts
from tidemill.plans.skew import lookup_join
from tidemill.queries.base import query, table, text

ORDER_REDACTIONS = {
    "redactions": [
        {"path": "customer", "type": "drop"},
        {"path": "address.firstName", "type": "drop"},
        {"path": "address.houseNumber", "type": "redact"},
        {"path": "address.street", "type": "md5"},
        {"path": "address.phone", "type": "x-digits"},
        {"path": "address.latitude", "type": "truncate"},
    ]
}


@query(
    """SELECT o_orderkey AS id, 'REDACTED' AS house, md5(c_mktsegment || ' ' || c_nationkey) AS hashed,
    regexp_replace(left(c_name, length(c_name) - 4), '[0-9]', 'X', 'g') || right(c_name, 4) AS phone,
    CAST(printf('%.1f', c_acctbal) AS DOUBLE) AS latitude, 'houseNumber,phone,hashedStreet,truncatedLatitude' AS fields
    FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def redact_order(spark: SparkSession, sf: str) -> DataFrame:
    """A nested order document of known shape; whole sub-documents and fields go."""
    who = table(spark, sf, "customer").withColumn("o_custkey", F.col("c_custkey"))
    rows = lookup_join(table(spark, sf, "orders"), who, ["o_custkey"], "inner")
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct("c_custkey", "c_name").alias("customer"),
        F.struct(
            F.col("c_name").alias("firstName"),
            F.col("c_nationkey").cast("string").alias("houseNumber"),
            text(F.col("c_mktsegment"), " ", F.col("c_nationkey")).alias("street"),
            F.col("c_name").alias("phone"),
            F.col("c_acctbal").alias("latitude"),
        ).alias("address"),
    )
    out = redact(rows.select(doc.alias("value")), ORDER_REDACTIONS, on_error="drop")
    address = out.schema["value"].dataType["address"].dataType.names
    v = F.col("value")
    return out.select(
        v["id"].alias("id"),
        v["address"]["houseNumber"].alias("house"),
        v["address"]["hashedStreet"].alias("hashed"),
        v["address"]["phone"].alias("phone"),
        v["address"]["truncatedLatitude"].alias("latitude"),
        F.lit(",".join(address)).alias("fields"),
    )


@query(
    """SELECT o_orderkey, '{"address":{"house":"REDACTED","phone":"C-XXXXX' || right(lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 4)
    || '","hashedStreet":"' || md5(o_orderpriority) || '","truncatedSize":' || CASE WHEN o_custkey % 2 = 0 THEN '-92.0' ELSE '12.3' END
    || '},"id":' || o_orderkey || ',"mail":"redacted@example.com"}' AS value FROM orders"""
)
def redact_json(spark: SparkSession, sf: str) -> DataFrame:
    """The same on JSON text of unknown shape."""
    value = text(
        '{"id":', F.col("o_orderkey"), ',"secret":{"status":"', F.col("o_orderstatus"), '"},"mail":"u', F.col("o_custkey"),
        '@example.com","address":{"street":"', F.col("o_orderpriority"), '","house":"', F.col("o_custkey"),
        '","phone":"C-', F.lpad(F.col("o_custkey").cast("string"), 9, "0"), '","size":',
        F.when(F.col("o_custkey") % 2 == 0, "-92.021109").otherwise("12.25001"), "}}",
    )
    config = {
        "redactions": [
            {"path": "secret", "type": "drop"},
            {"path": "mail", "type": "redactEmailUsername"},
            {"path": "address.house", "type": "redact"},
            {"path": "address.street", "type": "md5"},
            {"path": "address.phone", "type": "x-digits"},
            {"path": "address.size", "type": "truncate"},
            {"path": "address.absent", "type": "drop"},
        ]
    }
    return redact(table(spark, sf, "orders").select("o_orderkey", value.alias("value")), config, on_error="drop")


@query(
    """SELECT CASE WHEN c_custkey % 4 = 0 THEN 'missing path address.phone' WHEN c_custkey % 4 = 1
    THEN 'address.phone: too short to mask' WHEN c_custkey % 4 = 2 THEN 'invalid JSON' END AS error, count(*) AS n,
    count(CASE WHEN c_custkey % 4 = 3 THEN 1 END) AS kept FROM customer GROUP BY 1"""
)
def redact_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Records that cannot be redacted are rejected with their value hidden."""
    k = F.col("c_custkey") % 4
    value = (
        F.when(k == 0, '{"address":{}}')
        .when(k == 1, '{"address":{"phone":"123"}}')
        .when(k == 2, '{"address":')
        .otherwise(text('{"address":{"phone":"', F.col("c_name"), '"}}'))
    )
    config = {"redactions": [{"path": "address.phone", "type": "x-digits"}]}
    out = redact(table(spark, sf, "customer").select("c_custkey", value.alias("value")), config)
    return out.groupBy(F.col("_error").alias("error")).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("kept"))


@query(
    """SELECT c_custkey, 'gone' AS replaced, 'hidden@' || c_mktsegment AS before_sep, printf('%.1f', c_acctbal) AS rounded,
    md5(c_name) AS md5, sha1(c_name) AS sha1, 'p-' || c_name AS prepended,
    'p' || upper(left(lower(c_mktsegment), 1)) || substr(lower(c_mktsegment), 2) AS camel, c_name || '-s' AS appended,
    regexp_replace(left(c_name, length(c_name) - 4), '[0-9]', 'X', 'g') || right(c_name, 4) AS x_digits FROM customer"""
)
def redact_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Every redaction function on a column."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    calls = {
        "replaced": ({"function": "replace", "replacement": "gone"}, name),
        "before_sep": (
            {"function": "replaceBeforeSeparator", "replacement": "hidden", "separator": "@"},
            text(name, "@", segment),
        ),
        "rounded": ({"function": "truncateFloat64", "decimals": 1}, F.col("c_acctbal").cast("string")),
        "md5": ({"function": "md5"}, name),
        "sha1": ({"function": "sha1"}, name),
        "prepended": ({"function": "prepend", "prefix": "p-"}, name),
        "camel": ({"function": "camelPrepend", "prefix": "p"}, F.lower(segment)),
        "appended": ({"function": "append", "suffix": "-s"}, name),
        "x_digits": ({"function": "x-digits", "i": 4}, name),
    }
    cols = [bind(config)(col).alias(out) for out, (config, col) in calls.items()]
    return table(spark, sf, "customer").select("c_custkey", *cols)


@query(
    r"""SELECT doc_id, md5(regexp_replace(text, '\b[A-Za-z0-9._%+-]+(@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b)', 'redacted\1', 'g'))
    AS text_md5 FROM documents"""
)
def mask_emails(spark: SparkSession, sf: str) -> DataFrame:
    return mask_emails_in(table(spark, sf, "documents")).select("doc_id", F.md5("text").alias("text_md5"))


# -- timestamps --------------------------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.col("ts").alias("value"))


def _converted(spark: SparkSession, sf: str, target: str) -> DataFrame:
    return convert_ts(_events(spark, sf), "value", target)


@query("SELECT event_id, epoch_us(ts) // 1000000 AS value FROM events")
def ts_to_unix_s(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "unix")


@query("SELECT event_id, epoch_us(ts) // 1000 AS value FROM events")
def ts_to_unix_ms(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "unix[ms]")


@query("SELECT event_id, epoch_us(ts) AS value FROM events")
def ts_to_unix_us(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "UNIX[Microseconds]")


@query("SELECT event_id, epoch_us(ts) * 1000 AS value FROM events")
def ts_to_unix_ns(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "unix[ns]")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS value FROM events")
def ts_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "date").withColumn("value", F.col("value").cast("string"))


@query("SELECT event_id, epoch_us(ts) % 86400000000 AS value FROM events")
def ts_to_time(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "time")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
    WHEN epoch_us(ts) % 1000 = 0 THEN '.' || lpad(CAST(epoch_us(ts) % 1000000 // 1000 AS VARCHAR), 3, '0')
    ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00' AS value FROM events""")
def ts_to_string(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "string[%+]")


@query("SELECT event_id, strftime(ts, '%a %d %b %Y %H:%M:%S %j %y %I %p') AS value FROM events")
def ts_to_string_items(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "string[%a %d %b %Y %H:%M:%S %j %y %I %p]")


@query("SELECT event_id, (epoch_us(ts) - 3600000000) * 1000 + event_id % 1000 AS value FROM events")
def string_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    """RFC 3339 text with nine fraction digits and an offset, to nanoseconds."""
    e = table(spark, sf, "events")
    value = text(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), "+01:00"
    )
    return convert_ts(e.select("event_id", value.alias("value")), "value", "unix[ns]")


@query("SELECT event_id, epoch_us(ts) // 1000000 AS value FROM events WHERE event_id % 4 <> 0")
def custom_string_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Text of a given format; what cannot be read is dropped."""
    e = table(spark, sf, "events")
    good = text(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), " +0000")
    value = F.when(F.col("event_id") % 4 == 0, "not a time").otherwise(good)
    return convert_ts(e.select("event_id", value.alias("value")), "value", "unix", "%d/%m/%Y %H:%M:%S %z")


@query("""SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS from_int, epoch_us(ts) // 1000 // 1000 AS from_long,
    epoch_us(date_trunc('day', ts)) // 1000 AS from_date FROM events""")
def ts_from_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """int = seconds, long = milliseconds, date = midnight."""
    at = F.col("ts").cast("timestamp")
    rows = table(spark, sf, "events").select(
        "event_id",
        F.unix_seconds(at).cast("int").alias("from_int"),
        F.unix_millis(at).alias("from_long"),
        F.col("ts").cast("date").alias("from_date"),
    )
    for name, unit in (("from_int", "ms"), ("from_long", "s"), ("from_date", "ms")):
        rows = convert_ts(rows, "value", f"unix[{unit}]", value=name)
    return rows


@query("""SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000000 AS a FROM events""")
def ts_field_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Only the named field of the value changes."""
    e = table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("key"), F.struct(F.col("ts").alias("a"), F.col("event_type").alias("b")).alias("value")
    )
    out = convert_ts(e, "value[a]", "unix[s]")
    return out.select("event_id", "key", F.col("value.a").alias("a"), F.col("value.b").alias("kind"))


@query("""SELECT strftime(ts, '%H:%M') AS key, event_type AS value, count(*) AS n FROM events GROUP BY 1, 2""")
def ts_key_mode(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.col("ts").alias("key"), F.col("event_type").alias("value"))
    return convert_ts(e, "key", "string[%H:%M]").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


_PAST = "epoch_us(ts) - 2000000000000000"


@query(f"""WITH p AS (SELECT event_id, {_PAST} AS us FROM events)
    SELECT event_id, us // 1000000 AS seconds, us // 1000 AS millis, us // 86400000000 AS days,
    (us % 86400000000 + 86400000000) % 86400000000 AS time_us FROM p""")
def ts_before_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Instants before 1970: scales and days truncate toward zero, the time of day does not."""
    past = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - 2_000_000_000_000_000)
    e = table(spark, sf, "events")
    rows = e.select("event_id", *[past.alias(c) for c in ("seconds", "millis", "days", "time_us")])
    for name, target in (("seconds", "unix"), ("millis", "unix[ms]"), ("days", "date"), ("time_us", "time")):
        rows = convert_ts(rows, "value", target, value=name)
    return rows.withColumn("days", F.unix_date("days").cast("bigint"))


@query("""SELECT CASE event_id % 3 WHEN 0 THEN 'cannot convert to unix' END AS error, count(*) AS n,
    count(CASE WHEN event_id % 3 = 2 THEN 1 END) AS converted FROM events GROUP BY 1""")
def ts_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable text is rejected; null passes through."""
    good = text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "Z")
    value = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 2, good)
    out = convert_ts(table(spark, sf, "events").select("event_id", value.alias("value")), "value", "unix", on_error="reject")
    return out.groupBy(F.col("_error").alias("error")).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("converted"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) // 1000000 * 1000000
    WHEN 1 THEN epoch_us(ts) // 1000 * 1000 ELSE epoch_us(ts) END AS us FROM events""")
def normalised_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds, milliseconds, microseconds and nanoseconds mixed in one column."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 4
    mixed = F.when(k == 0, F.expr("unix_micros(CAST(ts AS timestamp)) div 1000000")).when(
        k == 1, F.expr("unix_micros(CAST(ts AS timestamp)) div 1000")
    ).when(k == 2, us).otherwise(us * 1000)
    return table(spark, sf, "events").select("event_id", normalise_epoch(mixed).alias("us"))


@query(
    """SELECT o_orderkey, '{"id":' || o_orderkey || ',"priority":"' || reverse(o_orderpriority) || '","owner":"<' || o_custkey || '>"}' AS value
    FROM orders"""
)
def redact_own(spark: SparkSession, sf: str) -> DataFrame:
    """Redactors of one's own from a packed configuration, one of them with a function of one's own."""
    register_function("mirror", lambda col, params: F.reverse(col))
    config = {
        "redactors": [
            {"name": "redact", "type": "value", "quote": True, "value": {"function": "prepend", "prefix": "<"}},
            {"name": "mirrored", "type": "value", "quote": True, "value": {"function": "mirror"}},
        ],
        "redactions": [{"path": "priority", "type": "mirrored"}, {"path": "owner", "type": "redact"}, {"path": "note", "type": "drop"}],
    }
    packed = base64.b64encode(gzip.compress(json.dumps(config).encode())).decode()
    value = text('{"id":', F.col("o_orderkey"), ',"note":1,"priority":"', F.col("o_orderpriority"), '","owner":"', F.col("o_custkey"), '>"}')
    rows = table(spark, sf, "orders").select("o_orderkey", value.alias("value"))
    out = redact(rows, packed, on_error="drop")
    # members come in the order of their names
    member = lambda name: F.get_json_object("value", f"$.{name}")
    return out.select(
        "o_orderkey", text('{"id":', member("id"), ',"priority":"', member("priority"), '","owner":"', member("owner"), '"}').alias("value")
    )
