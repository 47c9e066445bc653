"""Flow metrics, limits, sorted output, replay."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import flow as W
from tidemill.operators import limits as L
from tidemill.plans.ordered import with_global_index
from tidemill.queries.base import READABLE, REC, event_records, micros, query, readable, table
from tidemill.sources.replay import replay

#: an order is resolved when its last item is shipped
_ITEMS = """items AS (
  SELECT o_orderkey, o_orderpriority, o_orderdate AS created, done AS resolved, epoch_us(done) // 1000000
    - epoch_us(o_orderdate) // 1000000 AS took
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS done FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def _items(spark: SparkSession, sf: str) -> DataFrame:
    done = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("resolved"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").alias("created"))
    return orders.join(done, "o_orderkey", "left")


@query(f"WITH {_ITEMS} SELECT o_orderpriority, count(took) AS resolved, avg(took) AS avg_lead_seconds FROM items GROUP BY 1")
def lead_time(spark: SparkSession, sf: str) -> DataFrame:
    return W.lead_time(_items(spark, sf), "created", "resolved", ["o_orderpriority"])


@query("SELECT epoch_us(date_trunc('day', ts)) AS day_us, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def throughput_daily(spark: SparkSession, sf: str) -> DataFrame:
    out = W.throughput(table(spark, sf, "events"), "ts", "day", ["event_type"])
    return out.select(micros("period").alias("day_us"), "event_type", "n")


@query(
    """WITH a AS (SELECT o_orderpriority, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age FROM orders)
    SELECT age // 90 AS bucket, o_orderpriority, count(*) AS n, min(age) AS min_age, max(age) AS max_age,
    quantile_cont(CAST(age AS DOUBLE), 0.5) AS median_age, round(quantile_cont(CAST(age AS DOUBLE), 0.9), 6) AS p90_age FROM a GROUP BY 1, 2"""
)
def aging_buckets(spark: SparkSession, sf: str) -> DataFrame:
    out = W.aging(table(spark, sf, "orders"), "o_orderdate", 90, datetime(2001, 8, 2), ["o_orderpriority"])
    return out.withColumn("p90_age", F.round("p90_age", 6))


@query(
    f"""WITH {_ITEMS} SELECT o_orderpriority, count(took) AS resolved, count(CASE WHEN took <= 31536000 THEN 1 END)
    AS within_target, round(count(CASE WHEN took <= 31536000 THEN 1 END) * 100.0 / count(took), 6) AS percent
    FROM items GROUP BY 1"""
)
def sla_compliance(spark: SparkSession, sf: str) -> DataFrame:
    out = W.sla_compliance(_items(spark, sf), "created", "resolved", 365 * 86400, ["o_orderpriority"])
    return out.withColumn("percent", F.round("percent", 6))


@query("SELECT epoch_us(date_trunc('week', ts)) AS week_us, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def contributor_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = W.contributions(table(spark, sf, "events"), "user_id", "ts")
    return out.select(micros("period").alias("week_us"), "user_id", "n")


@query(
    """WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_type, epoch_us(ts) AS updated_us FROM l
    WHERE event_type IN ('error', 'purchase') AND ts < TIMESTAMP '2024-01-30' - INTERVAL 6 HOUR"""
)
def stale_keys(spark: SparkSession, sf: str) -> DataFrame:
    as_of = datetime(2024, 1, 30, 18)
    important = F.col("event_type").isin("error", "purchase")
    out = W.stale_items(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], 1, as_of, important)
    return out.select("user_id", "event_type", micros("ts").alias("updated_us"))


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a landed table."""
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


# -- limits and order --------------------------------------------------------------------------


@query("SELECT o_orderkey, epoch_us(o_orderdate) AS at_us FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def newest_n(spark: SparkSession, sf: str) -> DataFrame:
    out = L.newest(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 10)
    return out.select("o_orderkey", micros("o_orderdate").alias("at_us"))


@query(
    """WITH o AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
    SELECT 0 AS position, 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS value FROM o
    UNION ALL SELECT 1, 'o_orderpriority', o_orderpriority FROM o"""
)
def row_listing(spark: SparkSession, sf: str) -> DataFrame:
    last = L.newest(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 1)
    return L.list_row(last.select("o_orderkey", "o_orderpriority"))


@query(f"WITH {REC} SELECT {READABLE} FROM rec QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off) <= 3")
def first_of_topic(spark: SparkSession, sf: str) -> DataFrame:
    return readable(L.first_of_topic(event_records(spark, sf), 3))


@query(f"WITH {REC} SELECT {READABLE} FROM rec QUALIFY row_number() OVER (PARTITION BY topic, part ORDER BY off DESC) = 1")
def last_of_topic(spark: SparkSession, sf: str) -> DataFrame:
    return readable(L.last_of_topic(event_records(spark, sf)))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1"""
)
def sql_entry(spark: SparkSession, sf: str) -> DataFrame:
    """A SQL text over records, with the binary key decoded."""
    text = "SELECT key, count(*) AS n FROM {records} GROUP BY key"
    return L.run_sql(spark, text, decode=["key"], records=event_records(spark, sf))


@query(f"WITH {REC} SELECT {READABLE} FROM rec")
def replicate_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Every task holds a run of offsets in order; a large partition is cut into runs."""
    return readable(L.offset_order(event_records(spark, sf)))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS row_index FROM orders")
def reversed_index(spark: SparkSession, sf: str) -> DataFrame:
    """Rows numbered in reverse order, without a one-task sort."""
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return with_global_index(table(spark, sf, "orders"), order).select("o_orderkey", "row_index")


@query(
    """WITH r AS (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS i
      FROM orders), n AS (SELECT count(*) AS size, max(o_orderdate) AS newest FROM orders)
    SELECT o_orderkey, CAST(l AS INTEGER) AS loop, l * size + i AS seq,
      strftime(CASE WHEN l = 0 THEN o_orderdate ELSE newest + to_days(CAST((l - 1) * size + i + 1 AS INTEGER)) END, '%Y-%m-%d') AS day
    FROM r, n, range(3) AS loops(l)"""
)
def replay_reversed(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    out = replay(orders, ["o_orderdate", "o_orderkey"], reverse=True, loops=2, date_col="o_orderdate")
    return out.select("o_orderkey", "loop", "seq", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


