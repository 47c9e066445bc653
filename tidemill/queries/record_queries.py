"""Filters, projections, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.settings import configured
from tidemill.functions.text import EMAIL_PATTERN, contains_any
from tidemill.operators import records as R
from tidemill.operators.json_ops import flatten_json
from tidemill.plans.skew import lookup_join
from tidemill.queries.base import AS_OF, READABLE, REC, event_records, micros, query, readable, table, text
from tidemill.sources import changes as C


@query(
    r"""SELECT doc_id, n_chars FROM documents
    WHERE regexp_matches(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b')"""
)
def regex_filter_email(spark: SparkSession, sf: str) -> DataFrame:
    docs = R.regex_filter(table(spark, sf, "documents"), EMAIL_PATTERN, True, value="text")
    return docs.select("doc_id", "n_chars")


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE regexp_matches(key, '^1[0-9]*[05]$')")
def regex_filter_key(spark: SparkSession, sf: str) -> DataFrame:
    return readable(R.regex_filter(event_records(spark, sf), "^1[0-9]*[05]$"))


@query(
    f"""WITH {REC}, v AS (SELECT *, CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE value END AS body FROM rec)
    SELECT topic, count(*) AS n FROM v WHERE body IS NOT NULL AND body <> '' GROUP BY topic"""
)
def drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    body = F.when(F.col("event_id") % 3 == 1, "").when(F.col("event_id") % 3 == 2, F.col("props"))
    rows = R.to_records(events, text("events-", F.col("event_type")), body)
    return R.drop_empty(rows).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT doc_id, source FROM documents
    WHERE (starts_with(source, 'src1') OR source = 'src3') AND NOT (source = 'src13' OR starts_with(source, 'src19'))"""
)
def name_filter_prefix(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        {"filter_type": "INCLUDE", "pattern_type": "PREFIX", "name": "src1"},
        {"filter_type": "INCLUDE", "pattern_type": "LITERAL", "name": "src3"},
        {"filter_type": "EXCLUDE", "pattern_type": "LITERAL", "name": "src13"},
        {"filter_type": "EXCLUDE", "pattern_type": "PREFIX", "name": "src19"},
    ]
    return R.name_filter(table(spark, sf, "documents"), "source", rules).select("doc_id", "source")


@query(
    """SELECT n_nationkey, n_name FROM nation WHERE n_name IS NOT NULL AND NOT starts_with(n_name, 'NATION_1')"""
)
def name_filter_all_but(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        {"filter_type": "INCLUDE", "pattern_type": "LITERAL", "name": "*"},
        {"filter_type": "EXCLUDE", "pattern_type": "PREFIX", "name": "NATION_1"},
    ]
    return R.name_filter(table(spark, sf, "nation"), "n_name", rules).select("n_nationkey", "n_name")


@query("SELECT event_id, epoch_us(ts) AS ts_us FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY")
def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    return R.since(table(spark, sf, "events"), "ts", 7, AS_OF).select("event_id", micros("ts").alias("ts_us"))


@query(
    f"""WITH {REC} SELECT topic, part, off, user_id, event_type AS kind, CAST(props->>'$.k' AS INTEGER) AS k,
    CAST(NULL AS VARCHAR) AS absent FROM rec"""
)
def project_json_props(spark: SparkSession, sf: str) -> DataFrame:
    fields = {
        "user_id": ("user.id", "bigint"),
        "kind": ("user.type", "string"),
        "k": ("props.k", "int"),
        "absent": ("props.nothing", "string"),
    }
    rows = R.project_json(event_records(spark, sf), fields, keep=["topic", "partition", "offset"])
    return rows.withColumnsRenamed({"partition": "part", "offset": "off"})


@query(
    """SELECT event_id, CAST(user_id || '.' || (event_id % 100) AS DOUBLE) AS latitude,
    CAST('-' || (user_id % 90) || '.5' AS DOUBLE) AS longitude, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS timestamp
    FROM events WHERE event_id % 7 <> 0"""
)
def typed_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric text in JSON as doubles; unreadable positions are dropped."""
    e = table(spark, sf, "events")
    lat = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(
        text(F.col("user_id"), ".", F.col("event_id") % 100)
    )
    value = text(
        '{"message":"success","timestamp":', F.unix_seconds(F.col("ts").cast("timestamp")),
        ',"position":{"latitude":"', lat, '","longitude":"-', F.col("user_id") % 90, '.5"}}',
    )
    fields = {
        "latitude": ("position.latitude", "double"),
        "longitude": ("position.longitude", "double"),
        "timestamp": ("timestamp", "int"),
    }
    return R.project_json(e.withColumn("value", value), fields, keep=["event_id"], on_error="drop",
                          strict=["latitude", "longitude", "timestamp"])


@query(
    """SELECT o_orderkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), 'Unassigned') AS assignee,
    coalesce(c_name, 'Unknown') AS reporter FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
)
def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("assignee"),
        F.col("c_name").alias("reporter"),
    )
    rows = lookup_join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), who, ["o_custkey"])
    return R.with_defaults(rows, {"assignee": "Unassigned", "reporter": "Unknown"}).drop("o_custkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    'part-' || l_partkey || ',supp-' || l_suppkey AS names FROM lineitem"""
)
def names_of_objects(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    objects = F.array(
        F.struct(text("part-", F.col("l_partkey")).alias("name"), F.col("l_tax").alias("x")),
        F.struct(text("supp-", F.col("l_suppkey")).alias("name"), F.col("l_tax").alias("x")),
    )
    names = F.array_join(R.names_of(objects), ",")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", names.alias("names"))


@query(
    """SELECT p_partkey, contains(lower(p_type), 'eco') OR contains(lower(p_type), 'promo') AS flag FROM part"""
)
def contains_any_flag(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", contains_any(F.col("p_type"), ["eco", "Promo"]).alias("flag"))


@query("""SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_high_priority FROM orders""")
def membership_flag(spark: SparkSession, sf: str) -> DataFrame:
    flag = R.is_one_of(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])
    return table(spark, sf, "orders").select("o_orderkey", flag.alias("is_high_priority"))


_RULES_SQL = "o_orderpriority IN ('1-URGENT', '2-HIGH')"


def _rules() -> list:
    return [
        (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "orders.high"),
        (F.col("o_orderstatus") == "F", "orders.done"),
    ]


@query(
    f"""SELECT o_orderkey, CASE WHEN {_RULES_SQL} THEN 'orders.high' WHEN o_orderstatus = 'F' THEN 'orders.done'
    ELSE 'orders.all' END AS topic FROM orders"""
)
def route_first_match(spark: SparkSession, sf: str) -> DataFrame:
    return R.route(table(spark, sf, "orders"), _rules(), "orders.all").select("o_orderkey", "topic")


@query(
    f"""SELECT o_orderkey, 'orders.high' AS topic FROM orders WHERE {_RULES_SQL}
    UNION ALL SELECT o_orderkey, 'orders.done' FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'orders.all' FROM orders"""
)
def route_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    return R.route(table(spark, sf, "orders"), _rules(), "orders.all", inclusive=True).select("o_orderkey", "topic")


@query("""SELECT o_orderkey, 'orders.urgent' AS topic FROM orders WHERE o_orderpriority = '1-URGENT'""")
def route_or_drop(spark: SparkSession, sf: str) -> DataFrame:
    labels = F.array(F.lower("o_orderpriority"))
    rules = [(F.array_contains(labels, "1-urgent"), "orders.urgent")]
    return R.route(table(spark, sf, "orders"), rules).select("o_orderkey", "topic")


@query("""SELECT conv_id, turn, role || ': ' || text AS line FROM conversations""")
def chat_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    name_first = F.to_json(F.struct(F.col("role").alias("user"), F.col("text").alias("message")))
    other = F.to_json(F.struct(F.col("role").alias("username"), F.col("text").alias("message")))
    value = F.when(F.col("turn") % 2 == 0, name_first).otherwise(other)
    return R.chat_lines(c.select("conv_id", "turn", value.cast("binary").alias("value"))).drop("value")


@query(f"WITH {REC} SELECT key, value, part FROM rec")
def decode_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_records(spark, sf).select("key", "value", F.col("partition").alias("part"))
    return R.decode_cols(rows, ["key", "value", "not_a_column"])


# -- issues ----------------------------------------------------------------------------------

_ISSUES = """
issues AS (
  SELECT 'P-' || o_orderkey AS issue_key, 'order of ' || o_custkey AS summary,
    CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'In Progress' ELSE 'Resolved by customer' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Highest' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low'
      ELSE 'Medium' END AS priority,
    'Task' AS issue_type, 'https://issues.example.com/browse/P-' || o_orderkey AS url,
    CASE WHEN o_custkey % 5 = 0 THEN 'Unassigned' ELSE 'user-' || o_custkey END AS assignee,
    CASE WHEN o_custkey % 7 = 0 THEN 'Unknown' ELSE 'user-' || (o_custkey % 11) END AS reporter,
    strftime(o_orderdate, '%Y-%m-%d') AS created, strftime(o_orderdate, '%Y-%m-%d') AS updated,
    o_orderpriority || '|' || o_orderstatus AS labels, 'c' || (o_orderkey % 3) AS components, o_orderstatus
  FROM orders),
flagged AS (
  SELECT *, o_orderstatus <> 'O' AS is_completed, priority IN ('Highest', 'High') AS is_high_priority FROM issues),
routed AS (
  SELECT *, CASE WHEN is_high_priority THEN 'jira.issues.high-priority' WHEN is_completed THEN 'jira.issues.completed'
    ELSE 'jira.issues.all' END AS topic FROM flagged)
"""
_ISSUE_COLS = (
    "issue_key, summary, status, priority, issue_type, url, assignee, reporter, created, updated, "
    "labels, components, is_completed, is_high_priority, topic"
)


def issues_of(orders: DataFrame) -> DataFrame:
    """Orders as JSON issues of the tracker's shape."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'In Progress' ELSE 'Resolved by customer' END"
    )
    priority = F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Highest' WHEN '2-HIGH' THEN 'High' "
        "WHEN '5-LOW' THEN 'Low' ELSE 'Medium' END"
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = F.struct(
        text("order of ", cust).alias("summary"),
        F.struct(status.alias("name")).alias("status"),
        F.struct(priority.alias("name")).alias("priority"),
        F.struct(F.lit("Task").alias("name")).alias("issuetype"),
        F.when(cust % 5 != 0, F.struct(text("user-", cust).alias("displayName"))).alias("assignee"),
        F.when(cust % 7 != 0, F.struct(text("user-", cust % 11).alias("displayName"))).alias("reporter"),
        day.alias("created"),
        day.alias("updated"),
        F.array("o_orderpriority", "o_orderstatus").alias("labels"),
        F.array(F.struct(text("c", key % 3).alias("name"))).alias("components"),
    )
    return orders.select(F.to_json(F.struct(text("P-", key).alias("key"), fields.alias("fields"))).alias("value"))


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    raw = issues_of(table(spark, sf, "orders"))
    typed = raw.select(F.from_json("value", C.ISSUE_SCHEMA).alias("i")).select("i.*")
    flat = C.map_issues(typed, "https://issues.example.com").drop("resolved")
    return flat.withColumns({"labels": F.array_join("labels", "|"), "components": F.array_join("components", "|")})


@query(f"WITH {_ISSUES} SELECT {_ISSUE_COLS} FROM routed")
def issue_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Nested issues to flat rows, flags, defaults, URL and topic."""
    rules, default = C.issue_rules()
    return R.route(_mapped(spark, sf), rules, default)


@query(
    f"""WITH {_ISSUES}, last7 AS (SELECT * FROM issues WHERE updated >= '2001-07-25')
    SELECT issue_key, updated FROM last7 ORDER BY updated DESC, issue_key DESC LIMIT 10"""
)
def issue_poll(spark: SparkSession, sf: str) -> DataFrame:
    """One poll: the ten newest issues updated in the last seven days."""
    rows = _mapped(spark, sf).withColumn("at", F.col("updated").try_cast("timestamp_ntz"))
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    return C.read_issue_pages(rows, 7, 10, as_of, "at", "issue_key").select("issue_key", "updated")


_FLAGSHIP = f"""WITH {REC}, kept AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN 'activity.sales' WHEN event_type = 'error' THEN 'activity.errors'
    ELSE 'activity.all' END AS route FROM rec WHERE regexp_matches(value, '"k": [1-9][0-9]'))
SELECT route AS topic, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users
FROM kept GROUP BY 1, 2"""


@query(_FLAGSHIP)
def routed_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records filtered by a pattern, flattened, routed and counted per topic and day."""
    kept = R.regex_filter(event_records(spark, sf), '"k": [1-9][0-9]', True)
    flat = flatten_json(kept, on_error="drop").drop("topic")
    fields = {"kind": ("$['user.type']", "string"), "user_id": ("$['user.id']", "bigint")}
    rows = R.project_json(flat, fields, keep=["timestamp"])
    rules = [(F.col("kind") == "purchase", "activity.sales"), (F.col("kind") == "error", "activity.errors")]
    routed = R.route(rows, rules, "activity.all").withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    return routed.groupBy("topic", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@query(f"WITH {REC} SELECT topic, off, unnest([event_type, CAST(event_id AS VARCHAR)]) AS tag FROM rec WHERE event_id % 3 <> 0")
def record_callback(spark: SparkSession, sf: str) -> DataFrame:
    """A callback over Arrow batches that gives none or two rows for a record."""
    rows = event_records(spark, sf).select("topic", F.col("offset").alias("off"), "partition", "value")

    def tags(batches):
        import json

        import pyarrow as pa

        for batch in batches:
            out = []
            for topic, off, part, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (off * 4 + part) % 3:
                    out += [(topic, off, str(tag)) for tag in json.loads(value)["tags"]]
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                names=["topic", "off", "tag"],
            )

    return R.apply_each(rows, tags, "topic string, off long, tag string")


@query("SELECT event_id, true AS stamped, 1::BIGINT AS times FROM events")
def processing_time(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of a run has the same processing time, not before the run."""
    rows = R.with_processing_time(table(spark, sf, "events").select("event_id"))
    times = rows.agg(F.count_distinct("processed_at").alias("times"))
    stamped = rows.select("event_id", (F.col("processed_at") > F.lit("2024-01-01").cast("timestamp")).alias("stamped"))
    return stamped.join(F.broadcast(times))  # one row


@query(f"WITH {REC} SELECT {READABLE} FROM rec WHERE regexp_matches(value, 'error')")
def configured_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A filter whose parameters come from settings by name."""
    run = configured(R.regex_filter, {"PATTERN": "error", "MATCH_VALUE": "yes"})
    return readable(event_records(spark, sf).transform(run))
