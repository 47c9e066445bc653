"""Compaction, change logs, history, reconciliation, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import compare as X
from tidemill.operators import keyed as K
from tidemill.operators.records import to_records
from tidemill.plans.shared import materialize
from tidemill.queries.base import AS_OF, READABLE, REC, event_records, micros, query, readable, table, text
from tidemill.queries.registry_queries import registry_of
from tidemill.sources import changes as C
from tidemill.sources.topics import from_offset_table, from_offsets, subscribe_pattern

_LAST_IN_PARTITION = "row_number() OVER (PARTITION BY topic, part, key ORDER BY off DESC) = 1"
# every ninth record is a tombstone
_TOMB = f"{REC}, t AS (SELECT * REPLACE (CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value) FROM rec)"


def _with_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("offset") * 4 + F.col("partition")
    return event_records(spark, sf).withColumn("value", F.when(number % 9 != 0, F.col("value")))


@query(f"WITH {_TOMB}, l AS (SELECT * FROM t QUALIFY {_LAST_IN_PARTITION}) SELECT {READABLE} FROM l WHERE value IS NOT NULL")
def compact_partition(spark: SparkSession, sf: str) -> DataFrame:
    return readable(K.compact(_with_tombstones(spark, sf)))


@query(
    """SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    out = K.latest_by_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    return out.select("event_id", "user_id", "event_type", micros("ts").alias("ts_us"), "props")


@query(
    f"""WITH {_TOMB}, l AS (SELECT *, {_LAST_IN_PARTITION} AS newest FROM t)
    SELECT {READABLE} FROM l WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 5 DAY OR (newest AND value IS NOT NULL)"""
)
def compact_min_lag(spark: SparkSession, sf: str) -> DataFrame:
    return readable(K.compact_with_lag(_with_tombstones(spark, sf), 5 * 86400, AS_OF))


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 1 DAY")
def retention(spark: SparkSession, sf: str) -> DataFrame:
    return readable(K.retain(event_records(spark, sf), 86400, AS_OF))


@query(
    f"""WITH {_TOMB}, l AS (SELECT * FROM t QUALIFY {_LAST_IN_PARTITION})
    SELECT {READABLE} FROM l WHERE value IS NOT NULL AND ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY"""
)
def compact_delete(spark: SparkSession, sf: str) -> DataFrame:
    return readable(K.compact_delete(_with_tombstones(spark, sf), 7 * 86400, AS_OF))


# -- change logs -------------------------------------------------------------------------------

_ROW = "order_id bigint, customer_id bigint, total double, state string"


def change_records(orders: DataFrame) -> DataFrame:
    """A change log of orders: all are in the snapshot, two thirds are updated once more,
    every seventh is deleted at the end."""
    key = F.col("o_orderkey")

    def image(state):
        return F.struct(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("total"),
            state.alias("state"),
        )

    none = F.lit(None).cast(f"struct<{_ROW.replace(' ', ':').replace(',:', ',')}>")
    first, second = image(F.lit("new")), image(F.col("o_orderstatus"))
    snapshot = C.as_changes(F.when(key % 2 == 0, "r").otherwise("c"), none, first, key * 10)
    update = F.when(key % 3 != 0, C.as_changes(F.lit("u"), first, second, key * 10 + 1))
    delete = F.when(key % 7 == 0, C.as_changes(F.lit("d"), F.when(key % 3 != 0, second).otherwise(first), none, key * 10 + 2))
    return orders.select(key.alias("key"), F.explode(F.array_compact(F.array(snapshot, update, delete))).alias("value"))


@query(
    """WITH c AS (
      SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN 'r' ELSE 'c' END AS op, 'new' AS state, 0 AS n,
        o_custkey, o_totalprice FROM orders
      UNION ALL SELECT o_orderkey, 'u', o_orderstatus, 1, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0
      UNION ALL SELECT o_orderkey, 'd', CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE 'new' END, 2, o_custkey,
        o_totalprice FROM orders WHERE o_orderkey % 7 = 0)
    SELECT order_id, op, state, order_id * 10 + n AS ts_ms, o_custkey AS customer_id, o_totalprice AS total FROM c"""
)
def cdc_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    log = C.read_changes(change_records(table(spark, sf, "orders")), _ROW, on_error="drop")
    return K.unwrap_changes(log).select("order_id", "op", "state", "ts_ms", "customer_id", "total")


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE 'new' END AS state FROM orders WHERE o_orderkey % 7 <> 0"""
)
def cdc_current(spark: SparkSession, sf: str) -> DataFrame:
    log = C.read_changes(change_records(table(spark, sf, "orders")), _ROW, on_error="drop")
    rows = K.unwrap_changes(log).select("order_id", "op", "ts_ms", "customer_id", "total", "state")
    return K.current_rows(rows, ["order_id"], ["ts_ms"]).drop("op", "ts_ms")


@query(
    """SELECT event_id, user_id, event_type, epoch_us(ts) AS valid_from,
    epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS valid_to FROM events"""
)
def history_intervals(spark: SparkSession, sf: str) -> DataFrame:
    out = K.history_intervals(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    return out.select(
        "event_id", "user_id", "event_type", micros("valid_from").alias("valid_from"), micros("valid_to").alias("valid_to")
    )


@query(
    """WITH s AS (SELECT user_id, min(ts) AS started FROM events WHERE event_type = 'signup' GROUP BY 1),
    f AS (SELECT user_id, min(ts) AS finished FROM events JOIN s USING (user_id)
      WHERE event_type = 'purchase' AND ts > started GROUP BY 1)
    SELECT user_id, epoch_us(started) AS started_us, epoch_us(finished) AS finished_us,
      (epoch_us(finished) - epoch_us(started)) // 1000000 AS cycle_seconds FROM s LEFT JOIN f USING (user_id)"""
)
def cycle_time(spark: SparkSession, sf: str) -> DataFrame:
    out = K.first_then(
        table(spark, sf, "events"), ["user_id"], "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase"
    )
    return out.select("user_id", micros("started").alias("started_us"), micros("finished").alias("finished_us"), "cycle_seconds")


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id FROM events")
def poll_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Three overlapping polls of the same items."""
    polls = table(spark, sf, "events").withColumn("poll", F.explode(F.sequence(F.lit(1), F.lit(3))))
    out = K.dedupe_polls(polls.select("event_id", "ts", "user_id"), ["event_id", "ts", "user_id"])
    return out.select("event_id", micros("ts").alias("ts_us"), "user_id")


# -- source and replica ------------------------------------------------------------------------

# the replica: nothing of the errors, 96 % of the clicks, 50 % of the views, one topic of its own
_TGT = f"""{REC}, tgt AS (
  SELECT * REPLACE (CASE WHEN event_type = 'signup' AND off % 2 = 0 THEN 'events-extra' ELSE topic END AS topic)
  FROM rec WHERE event_type <> 'error'
    AND NOT (event_type = 'click' AND off > (SELECT max(off) * 96 // 100 FROM rec))
    AND NOT (event_type = 'view' AND off > (SELECT max(off) // 2 FROM rec)))"""


def _replica(records: DataFrame) -> DataFrame:
    top = records.agg(F.max("offset")).first()[0]  # one number
    kept = records.filter(
        (F.col("topic") != "events-error")
        & ~((F.col("topic") == "events-click") & (F.col("offset") > top * 96 // 100))
        & ~((F.col("topic") == "events-view") & (F.col("offset") > top // 2))
    )
    moved = (F.col("topic") == "events-signup") & (F.col("offset") % 2 == 0)
    return kept.withColumn("topic", F.when(moved, "events-extra").otherwise(F.col("topic")))


def _stats(name: str) -> str:
    return (
        f"(SELECT topic, CAST(sum(e) AS BIGINT) AS messages, count(*) AS partitions FROM "
        f"(SELECT topic, part, max(off) + 1 AS e FROM {name} GROUP BY 1, 2) GROUP BY 1)"
    )


@query(f"WITH {REC} SELECT topic, messages FROM {_stats('rec')}")
def message_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.message_counts(event_records(spark, sf))


@query(f"WITH {REC} SELECT topic, partitions FROM {_stats('rec')}")
def partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.partition_counts(event_records(spark, sf))


@query(
    f"""WITH {_TGT}, s AS (SELECT topic, part, max(off) + 1 AS e FROM rec GROUP BY 1, 2),
    t AS (SELECT topic, part, max(off) + 1 AS e FROM tgt GROUP BY 1, 2)
    SELECT topic, CAST(sum(greatest(coalesce(s.e, 0) - coalesce(t.e, 0), 0)) AS BIGINT) AS lag
    FROM s FULL JOIN t USING (topic, part) GROUP BY topic"""
)
def lag_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    source = event_records(spark, sf)
    return X.lag_by_topic(source, _replica(source))


@query(
    f"""WITH {_TGT}, s AS {_stats('rec')}, t AS {_stats('tgt')}
    SELECT coalesce(s.topic, t.topic) AS topic, s.messages AS source_messages, t.messages AS target_messages,
      s.partitions AS source_partitions, t.partitions AS target_partitions,
      coalesce(s.partitions = t.partitions, false) AS partitions_match,
      CASE WHEN t.topic IS NULL THEN 'source only' WHEN s.topic IS NULL THEN 'target only'
        WHEN s.messages = t.messages THEN 'equal' WHEN t.messages >= s.messages * 95 // 100 THEN 'close'
        ELSE 'mismatch' END AS verdict
    FROM s FULL JOIN t ON s.topic = t.topic"""
)
def reconcile_topics(spark: SparkSession, sf: str) -> DataFrame:
    source = event_records(spark, sf)
    return X.reconcile_topics(source, _replica(source))


@query(
    """WITH c AS (SELECT 'region-' || n_regionkey || CASE n_nationkey % 3 WHEN 0 THEN '-state-' WHEN 1 THEN '-events-'
        ELSE '-logs-' END || n_nationkey AS topic, CASE n_nationkey % 2 WHEN 0 THEN 'compact' ELSE 'delete' END AS v,
        n_nationkey FROM nation)
    SELECT topic, v AS source, CASE WHEN n_nationkey % 5 = 0 THEN 'delete' ELSE v END AS target,
      v = CASE WHEN n_nationkey % 5 = 0 THEN 'delete' ELSE v END AS matches FROM c WHERE topic NOT LIKE '%logs%'"""
)
def config_matches(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    kind = F.when(k % 3 == 0, "-state-").when(k % 3 == 1, "-events-").otherwise("-logs-")
    policy = F.when(k % 2 == 0, "compact").otherwise("delete")
    source = table(spark, sf, "nation").select(
        k, text("region-", F.col("n_regionkey"), kind, k).alias("topic"), F.lit("cleanup.policy").alias("name"), policy.alias("value")
    )
    target = source.withColumn("value", F.when(k % 5 == 0, "delete").otherwise(F.col("value")))
    return X.config_matches(source, target)


@query(
    f"""WITH {_TGT}, s AS (SELECT DISTINCT topic FROM rec), t AS (SELECT DISTINCT topic FROM tgt),
    g AS (SELECT count(DISTINCT s_suppkey % 20) AS schemas FROM supplier)
    SELECT count(*) AS total, count(t.topic) AS migrated, any_value(schemas) AS schemas,
      count(*) = count(t.topic) AND any_value(schemas) > 0 AS complete FROM s LEFT JOIN t USING (topic), g"""
)
def migration_summary(spark: SparkSession, sf: str) -> DataFrame:
    source = event_records(spark, sf)
    return X.migration_summary(source, _replica(source), registry_of(table(spark, sf, "supplier")))


@query(f"WITH {_TGT} SELECT topic FROM rec EXCEPT SELECT topic FROM tgt")
def names_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Topics the replica lacks."""
    source = event_records(spark, sf)
    return X.only_in(source, _replica(source), ["topic"])


@query(f"WITH {_TGT} SELECT topic FROM rec INTERSECT SELECT topic FROM tgt")
def names_in_both(spark: SparkSession, sf: str) -> DataFrame:
    source = event_records(spark, sf)
    return X.in_both(source, _replica(source), ["topic"])


@query(
    f"""WITH {_TGT}, d AS (SELECT (SELECT count(*) FROM (SELECT topic FROM rec EXCEPT SELECT topic FROM tgt)) AS a,
      (SELECT count(*) FROM (SELECT topic FROM tgt EXCEPT SELECT topic FROM rec)) AS b)
    SELECT a AS only_first, b AS only_second, a = 0 AND b = 0 AS equal FROM d"""
)
def names_equal(spark: SparkSession, sf: str) -> DataFrame:
    source = event_records(spark, sf)
    return X.sets_equal(source, _replica(source), ["topic"])


@query(
    f"""WITH {REC} SELECT {READABLE} FROM rec
    UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderpriority, 'orders', CAST(o_orderkey % 12 AS INTEGER),
      o_orderkey // 12, epoch_us(o_orderdate) FROM orders"""
)
def merge_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables' topics as one sequence of records."""
    orders = to_records(
        table(spark, sf, "orders"),
        "orders",
        F.col("o_orderpriority"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderkey") % 12,
        F.expr("o_orderkey div 12"),
        F.col("o_orderdate"),
    )
    return readable(X.merge_topics(event_records(spark, sf), orders))


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE topic IN ('events-error', 'events-signup')")
def subscribe_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return readable(subscribe_pattern(event_records(spark, sf), "events-(error|sign.*)"))


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE NOT (topic = 'events-click' AND part = 1 AND off < 100)"
       " AND NOT (topic = 'events-view' AND part = 3 AND off < 7)")  # fmt: skip
def start_at_offsets(spark: SparkSession, sf: str) -> DataFrame:
    start = {("events-click", 1): 100, ("events-view", 3): 7}
    return readable(from_offsets(event_records(spark, sf), start))


_CUT = "cut AS (SELECT topic, part, max(off) // 2 AS cut FROM rec WHERE part < 3 GROUP BY 1, 2)"


def _cut(records: DataFrame) -> DataFrame:
    """Committed offsets, as a table of their own: one row per topic partition."""
    return materialize(
        records.filter(F.col("partition") < 3)
        .groupBy("topic", "partition")
        .agg(F.max("offset").alias("m"))
        .select("topic", "partition", F.expr("m div 2").alias("offset"))
    )


@query(f"WITH {REC}, {_CUT} SELECT {READABLE} FROM rec LEFT JOIN cut USING (topic, part) WHERE off >= coalesce(cut, 0)")
def resume_from_replicated(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf)
    return readable(from_offset_table(rows, _cut(rows)))


@query(
    f"""WITH {REC}, {_CUT}
    SELECT key, CASE WHEN off >= cut THEN 'replica' ELSE 'source' END AS value, topic, part, off, epoch_us(ts) AS ts_us
    FROM rec LEFT JOIN cut USING (topic, part)"""
)
def failover_union(spark: SparkSession, sf: str) -> DataFrame:
    """No gap and no duplicate: the source's records up to the cut, then the replica's."""
    rows = event_records(spark, sf)
    source, replica = [rows.withColumn("value", F.lit(v).cast("binary")) for v in ("source", "replica")]
    return readable(X.fail_over(source, replica, _cut(rows)))
