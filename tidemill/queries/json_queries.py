"""JSON and CSV operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import money_to_decimal
from tidemill.operators import csv_ops as V
from tidemill.operators import json_ops as J
from tidemill.queries.base import REC, event_records, query, table, text


@query(
    f"""WITH {REC} SELECT topic, part, off, CAST(user_id AS VARCHAR) AS user_id, event_type AS kind,
    CAST(props->>'$.k' AS VARCHAR) AS k, '["' || event_type || '",' || event_id || ']' AS tags FROM rec"""
)
def flatten_json(spark: SparkSession, sf: str) -> DataFrame:
    flat = J.flatten_json(event_records(spark, sf), on_error="drop")

    def member(name: str):
        return F.get_json_object(F.col("value"), f"$['{name}']")

    return flat.select(
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        member("user.id").alias("user_id"),
        member("user.type").alias("kind"),
        member("props.k").alias("k"),
        member("tags").alias("tags"),
    )


@query(
    f"""WITH {REC}, leaves AS (
      SELECT topic, part, off, 'user.id' AS path, 'number' AS type, CAST(user_id AS VARCHAR) AS leaf FROM rec
      UNION ALL SELECT topic, part, off, 'user.type', 'string', '"' || event_type || '"' FROM rec
      UNION ALL SELECT topic, part, off, 'props.k', 'number', props->>'$.k' FROM rec
      UNION ALL SELECT topic, part, off, 'tags', 'array', '["' || event_type || '",' || event_id || ']' FROM rec
      UNION ALL SELECT topic, part, off, 'none', 'null', 'null' FROM rec)
    SELECT * FROM leaves"""
)
def json_paths(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), "value")
    return J.json_paths(rows, on_error="drop")


@query(
    """SELECT o_orderkey AS doc_key, o_orderstatus AS doc_state_status, o_orderpriority AS doc_state_priority,
    c_custkey AS doc_customer_key, c_name AS doc_customer_name FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    from tidemill.plans.skew import lookup_join

    who = table(spark, sf, "customer").withColumn("o_custkey", F.col("c_custkey"))
    rows = lookup_join(table(spark, sf, "orders"), who, ["o_custkey"], "inner")
    doc = F.struct(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("state"),
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).alias("customer"),
    )
    return J.flatten_struct(rows.select(doc.alias("doc")), "_")


@query(f"WITH {REC} SELECT topic, off, value FROM rec UNION ALL SELECT topic, off, props FROM rec")
def split_objects(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("topic", F.col("offset").alias("off"), F.col("value").cast("string").alias("v"))
    props = F.regexp_extract("v", r'"props":(\{[^}]*\})', 1)
    return J.split_objects(rows.withColumn("value", F.concat("v", F.lit("\n"), props)).drop("v"), on_error="drop")


@query(
    f"""WITH {REC} SELECT topic, off,
    '{{"none":null,"tags":["' || event_type || '",' || event_id || '],"user":{{"id":' || user_id || '}}}}' AS value
    FROM rec"""
)
def json_delete(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("topic", F.col("offset").alias("off"), "value")
    return J.json_delete(rows, ["user.type", "props", "not.there"], on_error="drop")


@query(
    f"""WITH {REC} SELECT key, topic, off, '{{"uid":' || user_id || ',"kind":"' || event_type || '","key":"' || key
    || '","gone":null}}' AS value FROM rec"""
)
def json_construct(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("key", "topic", F.col("offset").alias("off"), "value")
    fields = {"uid": "user.id", "kind": "user.type", "key": F.col(J.KEY_TEXT), "gone": "no.such"}
    built = J.json_construct(rows, fields, on_error="drop")
    return built.withColumn("key", F.col("key").cast("string"))


@query(f"WITH {REC} SELECT topic, off, CAST(props->>'$.k' AS BIGINT) AS k FROM rec WHERE CAST(props->>'$.k' AS BIGINT) > 50")
def json_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("topic", F.col("offset").alias("off"), "value")
    kept = J.json_filter(rows, "props.k", "bigint", lambda k: k > 50, on_error="drop")
    return kept.select("topic", "off", F.get_json_object(F.col("value").cast("string"), "$.props.k").cast("bigint").alias("k"))


@query(
    """SELECT l_orderkey AS key, '{"part":' || l_partkey || '}' AS value FROM lineitem
    UNION ALL SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) FROM lineitem"""
)
def json_explode(spark: SparkSession, sf: str) -> DataFrame:
    value = text('{"items":[{"part":', F.col("l_partkey"), "},", F.col("l_suppkey"), "]}")
    return J.json_explode(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), value.alias("value")), "items", on_error="drop")


_ODD_VALUES = """
odd AS (SELECT topic, event_id, off, CASE event_id % 6 WHEN 0 THEN value WHEN 1 THEN NULL WHEN 2 THEN '{broken' WHEN 3 THEN '[1,2]'
  WHEN 4 THEN '{"tags":{"no":"array"}}' ELSE value || ' junk' END AS value, event_id % 6 AS kind FROM rec)
"""


def _odd_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of which five in six have a missing, malformed or mistyped value."""
    kind = F.pmod(F.col("offset") * 4 + F.col("partition"), F.lit(6))
    value = F.col("value").cast("string")
    odd = (
        F.when(kind == 0, value).when(kind == 2, "{broken").when(kind == 3, "[1,2]")
        .when(kind == 4, '{"tags":{"no":"array"}}').when(kind == 5, F.concat(value, F.lit(" junk")))
    )
    return event_records(spark, sf).withColumn("value", odd)


@query(
    f"""WITH {REC}, {_ODD_VALUES}, o AS (SELECT 'json_explode' AS op, CASE kind WHEN 1 THEN 'missing value' WHEN 2 THEN 'invalid JSON' WHEN 3 THEN 'no array at tags'
      WHEN 4 THEN 'no array at tags' WHEN 5 THEN 'invalid JSON' END AS error, value, off FROM odd WHERE kind > 0
    UNION ALL SELECT p.op, CASE kind WHEN 1 THEN 'missing value' WHEN 2 THEN 'invalid JSON' WHEN 3 THEN 'not a JSON object'
      WHEN 5 THEN 'invalid JSON' END, value, off FROM odd, (SELECT unnest(['json_paths', 'split_objects']) AS op) p WHERE kind NOT IN (0, 4))
    SELECT op, error, count(*) AS n, coalesce(sum(length(value)), 0)::BIGINT AS chars, sum(off)::BIGINT AS offsets FROM o GROUP BY op, error"""
)
def json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What several operators reject, with the body and the offset that stay with the message."""
    rows = _odd_records(spark, sf).select("key", F.col("offset").alias("off"), "value")
    parts = {
        "json_explode": J.json_explode(rows, "tags"),
        "json_paths": J.json_paths(rows).withColumnRenamed("leaf", "value"),
        "split_objects": J.split_objects(rows),
    }
    out = None
    for name, df in parts.items():
        bad = df.filter(F.col("_error").isNotNull()).select(F.lit(name).alias("op"), F.col("_error").alias("error"), "value", "off")
        out = bad if out is None else out.unionByName(bad)
    chars = F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("chars")
    return out.groupBy("op", "error").agg(F.count(F.lit(1)).alias("n"), chars, F.sum("off").alias("offsets"))


@query(
    """SELECT CASE event_id % 5 WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'missing value' END AS error, count(*) AS n
    FROM events GROUP BY 1"""
)
def json_errors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    value = F.when(F.col("event_id") % 5 == 0, F.substr("props", F.lit(1), F.length("props") - 1)).when(
        F.col("event_id") % 5 > 1, F.col("props")
    )
    checked = J.validate_json(e.withColumn("value", value))
    return checked.groupBy(F.col("_error").alias("error")).agg(F.count(F.lit(1)).alias("n"))


# -- CSV ---------------------------------------------------------------------------------------


@query(
    """WITH v AS (SELECT l_orderkey AS key, l_partkey, l_suppkey, l_linenumber FROM lineitem)
    SELECT key, '{"item":"part-' || l_partkey || '","quantity":' || l_linenumber || '}' AS value,
      CAST(NULL AS VARCHAR) AS error FROM v
    UNION ALL SELECT key, '{"item":"supp-' || l_suppkey || '","quantity":12}', NULL FROM v
    UNION ALL SELECT key, NULL, 'unexpected number of columns' FROM v
    UNION ALL SELECT key, NULL, 'invalid quantity' FROM v
    UNION ALL SELECT key, NULL, 'unexpected number of columns' FROM v"""
)
def csv_lines_to_json(spark: SparkSession, sf: str) -> DataFrame:
    """Five lines per value: good, a number with a tail, three columns, no number, empty."""
    value = text("part-", F.col("l_partkey"), ",", F.col("l_linenumber"), "\nsupp-", F.col("l_suppkey"), ",12abc\na,1,2\nb,x\n")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), value.alias("value"))
    return V.csv_lines_to_json(rows).withColumnRenamed("_error", "error")


@query(
    """WITH v AS (SELECT l_orderkey AS key, l_partkey, l_linenumber, l_partkey % 2 = 0 AS ok FROM lineitem)
    SELECT key, '{"item":"part-' || l_partkey || '","quantity":' || l_linenumber || '}' AS value FROM v WHERE ok
    UNION ALL SELECT key, '{"item":"b","quantity":7}' FROM v WHERE ok"""
)
def csv_whole_records(spark: SparkSession, sf: str) -> DataFrame:
    """One bad line rejects its whole record."""
    second = F.when(F.col("l_partkey") % 2 == 0, "b,7").otherwise("b,x")
    value = text("part-", F.col("l_partkey"), ",", F.col("l_linenumber"), "\n", second)
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), value.alias("value"))
    return V.csv_lines_to_json(rows, on_error="drop", whole_record=True)


def stock_lines(orders: DataFrame) -> DataFrame:
    price = F.concat(F.lit("$"), F.col("o_totalprice").cast("string"))
    line = F.concat_ws(
        ",", F.date_format("o_orderdate", "MM/dd/yyyy"), price, F.col("o_custkey").cast("string"), price, price, price
    )
    return orders.select("o_orderkey", line.alias("value"))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS "Date", strftime(o_orderdate, '%Y-%m-%d') AS day,
    o_custkey AS "Volume", CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"""
)
def csv_to_record(spark: SparkSession, sf: str) -> DataFrame:
    typed = V.csv_to_record(stock_lines(table(spark, sf, "orders")), on_bad="drop")
    r = F.col("record")
    return typed.select(
        "o_orderkey",
        r["Date"].alias("Date"),
        V.us_date(r["Date"]).cast("string").alias("day"),
        r["Volume"].alias("Volume"),
        (money_to_decimal(r["Last"]) * 100).cast("bigint").alias("cents"),
    )


@query(
    """SELECT CASE o_orderkey % 3 WHEN 0 THEN 'unexpected number of columns' WHEN 1 THEN 'malformed field' END AS error,
    count(*) AS n, count(CASE WHEN o_orderkey % 3 = 2 THEN 1 END) AS typed FROM orders GROUP BY 1"""
)
def csv_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = stock_lines(table(spark, sf, "orders"))
    broken = F.when(F.col("o_orderkey") % 3 == 0, F.concat("value", F.lit(",more"))).when(
        F.col("o_orderkey") % 3 == 1, F.concat_ws(",", F.lit("01/01/2020,$1,many,$1,$1,$1"))
    ).otherwise(F.col("value"))
    typed = V.csv_to_record(lines.withColumn("value", broken))
    return typed.groupBy(F.col("_error").alias("error")).agg(
        F.count(F.lit(1)).alias("n"), F.count("record").alias("typed")
    )


@query("""SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"kind":' ||
    CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS value FROM events""")
def rows_to_json(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("view")).alias("kind")
    return V.rows_to_json(table(spark, sf, "events").select("event_id", "user_id", kind))
