"""Record-level filters, projections and routing.  All of them are narrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import jsonx as J
from tidemill.functions.errors import any_of, with_errors
from tidemill.functions.text import ascii_boundaries, is_true_word, required_text

HEADER_TYPE = "array<struct<key:string,value:binary>>"
#: column for column what Spark's Kafka source yields
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])),
        ),
    ]
)


def to_records(
    df: DataFrame,
    topic: Column | str,
    value: Column,
    key: Column | None = None,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows as records of :data:`RECORD_SCHEMA`."""
    null = F.lit(None)
    return df.select(
        (null if key is None else key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (null if partition is None else partition).cast("int").alias("partition"),
        (null if offset is None else offset).cast("bigint").alias("offset"),
        (null if timestamp is None else timestamp).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        null.cast(HEADER_TYPE).alias("headers"),
    )


def decode_cols(df: DataFrame, cols: Sequence[str] = ("key", "value")) -> DataFrame:
    """Binary columns as text; names the frame does not have are ignored."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols if c in df.columns})


def apply_each(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: T.StructType | str) -> DataFrame:
    """Escape hatch for a record callback that no expression can state: Arrow batches in
    and out, 0..n rows per row.  Prefer ``df.transform(operator, ...)``."""
    return df.mapInArrow(fn, schema)


# -- filters ---------------------------------------------------------------------------------


def regex_filter(
    df: DataFrame, pattern: str, match_value: bool | str = False, key: str = "key", value: str = "value"
) -> DataFrame:
    """Keep the records whose key (or value) contains the pattern; null never matches."""
    on_value = is_true_word(match_value) if isinstance(match_value, str) else match_value
    text = F.col(value if on_value else key).cast("string")
    found = text.rlike(ascii_boundaries(pattern))
    sure = required_text(pattern)
    return df.filter(text.contains(sure) & found if sure else text.isNotNull() & found)


def drop_empty(df: DataFrame, value: str = "value") -> DataFrame:
    """Leave out records without a value."""
    return df.filter(F.col(value).isNotNull() & (F.octet_length(value) > 0))


def name_filter(df: DataFrame, col: str, rules: Sequence[Mapping[str, str]]) -> DataFrame:
    """Include / exclude by name.

    A rule has ``filter_type`` include or exclude, ``pattern_type`` literal or prefix, and
    ``name``; the literal ``*`` means every name.  An exclude wins over an include.
    """
    include, exclude = [], []
    for rule in rules:
        kind, name = rule.get("pattern_type", "LITERAL").upper(), rule["name"]
        if kind not in ("LITERAL", "PREFIX"):
            raise ValueError(f"unknown pattern type {kind!r}")
        if kind == "PREFIX":
            test = F.col(col).startswith(name)
        else:
            test = F.col(col).isNotNull() if name == "*" else F.col(col) == name
        side = rule.get("filter_type", "INCLUDE").upper()
        if side not in ("INCLUDE", "EXCLUDE"):
            raise ValueError(f"unknown filter type {side!r}")
        (include if side == "INCLUDE" else exclude).append(test)
    return df.filter(any_of(include) & ~any_of(exclude))


def since(df: DataFrame, col: str, days: float, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows at most ``days`` old at ``as_of`` (now, if not given)."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.filter(F.col(col) >= now.cast(df.schema[col].dataType) - F.make_dt_interval(secs=F.lit(days * 86400.0)))


# -- projections -----------------------------------------------------------------------------


def project_json(
    df: DataFrame,
    fields: Mapping[str, tuple[str, str]],
    column: str = "value",
    keep: Sequence[str] = (),
    strict: Sequence[str] = (),
    on_error: str | None = None,
) -> DataFrame:
    """Flat columns from a JSON document: ``{name: (dotted path, type)}``.

    Absent or unconvertible values are null.  With ``on_error``, a row lacking one of the
    ``strict`` columns (all, if none are named) is an error.
    """
    parsed = df.withColumn("_doc", J.parse(F.col(column)))
    cols = [J.at(F.col("_doc"), path, kind).alias(name) for name, (path, kind) in fields.items()]
    out = parsed.select(*keep, *cols)
    if on_error is None:
        return out
    needed = list(strict) or list(fields)
    error = F.when(any_of([F.col(n).isNull() for n in needed]), "missing or malformed field")
    return with_errors(out, error, on_error, costly=True)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls, column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_processing_time(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """Add the time of processing, one value per batch."""
    return df.withColumn(name, F.current_timestamp())


def url_column(base: str, *parts: Column) -> Column:
    """A URL by concatenation; a null part makes it null."""
    return F.concat(F.lit(base), *parts)


def names_of(col: Column, field: str = "name") -> Column:
    """One field of every object in an array."""
    return F.transform(col, lambda x: x[field])


def is_one_of(col: Column, words: Sequence[str]) -> Column:
    """Exact membership."""
    return col.isin(list(words))


def chat_lines(df: DataFrame, column: str = "value", on_error: str = "drop") -> DataFrame:
    """``user: message`` lines from chat records; the name may be in ``user`` or ``username``."""
    doc = F.from_json(F.col(column).cast("string"), "user string, username string, message string")
    user = F.coalesce(doc["user"], doc["username"])
    line = F.concat(user, F.lit(": "), doc["message"])
    return with_errors(df.withColumn("line", line), F.when(F.col("line").isNull(), "not a chat message"), on_error)


# -- routing ---------------------------------------------------------------------------------


def route(
    df: DataFrame,
    rules: Sequence[tuple[Column, str]],
    default: str | None = None,
    inclusive: bool = False,
    out: str = "topic",
) -> DataFrame:
    """Name the topic of each row: the first rule that holds decides, else ``default``.

    Rows without a topic are removed.  ``inclusive`` sends a row to the topic of every
    rule that holds and always to ``default``, one copy each.
    """
    if inclusive:
        topics = [F.when(test, F.lit(topic)) for test, topic in rules]
        topics.append(F.lit(default).cast("string"))
        return df.withColumn(out, F.explode(F.array_distinct(F.array_compact(F.array(*topics)))))
    chain = F
    for test, topic in rules:
        chain = chain.when(test, topic)
    topic = chain.otherwise(F.lit(default).cast("string")) if rules else F.lit(default).cast("string")
    routed = df.withColumn(out, topic)
    return routed if default is not None else routed.filter(F.col(out).isNotNull())
