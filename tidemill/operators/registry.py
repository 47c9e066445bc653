"""Framed records and the schema table.

The registry is a table ``(subject, version, id, format, schema)``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import bodies as B
from tidemill.functions import wire as W
from tidemill.functions.compatibility import PROMOTIONS, problems
from tidemill.functions.errors import ERROR, keep_where, with_errors
from tidemill.plans.skew import lookup_join

MISMATCH = "payload does not match its schema"
REGISTRY_SCHEMA = "subject string, version int, id int, format string, schema string"

# --- fixed values -----------------------------------------------------------------------
#: defaults of a decoded click
CLICK_DEFAULTS = {"user_id": -1, "event_type": "unknown", "ts_millis": -1}
#: Avro primitive and logical types
AVRO_TYPES = {
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "time-micros": T.LongType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(),
    "local-timestamp-micros": T.TimestampNTZType(),
}
#: how a portable body is written: microseconds kept, null members written
BODY_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# ----------------------------------------------------------------------------------------


def frame_records(df: DataFrame, schema_id: int | Column, column: str = "value") -> DataFrame:
    """Put the frame header before the payload."""
    sid = F.lit(schema_id) if isinstance(schema_id, int) else schema_id
    return df.withColumn(column, W.frame(sid, F.col(column)))


def unframe_records(df: DataFrame, column: str = "value", on_error: str = "reject") -> DataFrame:
    """Split a framed payload into ``schema_id`` and body; null payloads pass."""
    tagged = with_errors(df, W.frame_error(F.col(column)), "reject")
    out = tagged.withColumn("schema_id", W.frame_id(F.col(column))).withColumn(column, W.frame_body(F.col(column)))
    return with_errors(out, F.lit(None).cast("string"), on_error)


def frame_messages(df: DataFrame, schema_id: int | Column, indexes: Column, column: str = "value") -> DataFrame:
    """Frame Protobuf bodies: header, the indexes of the message type in its file, body."""
    return frame_records(df.withColumn(column, F.concat(W.message_indexes(indexes), F.col(column).cast("binary"))), schema_id, column)


def unframe_messages(df: DataFrame, column: str = "value", on_error: str = "reject") -> DataFrame:
    """Split a framed Protobuf payload into ``schema_id``, ``message_indexes`` and body; null payloads pass, and a body whose
    indexes cannot be read is an error and keeps them."""
    rows = unframe_records(df, column).withColumn("_read", W.read_message_indexes(F.col(column)))
    bad = F.when(F.col(column).isNotNull() & F.col("_read").isNull(), "unreadable message indexes")
    body = F.when(F.col("_read").isNull(), F.col(column)).otherwise(F.substr(column, F.col("_read.size") + 1))
    split = rows.withColumns({"message_indexes": F.col("_read.indexes"), column: body, "_bad": bad}).drop("_read")
    # read once: a filter below would read the indexes again
    return with_errors(split, F.col("_bad"), on_error, costly=True).drop("_bad")


def with_schema(df: DataFrame, registry: DataFrame, on_error: str = "reject") -> DataFrame:
    """Attach ``schema`` and ``format`` by ``schema_id``; an unknown id is an error.

    One id may be used by several subjects; it always names the same schema.
    """
    by_id = registry.groupBy(F.col("id").alias("schema_id")).agg(
        F.min("schema").alias("schema"), F.min("format").alias("format")
    )
    joined = lookup_join(df, by_id, ["schema_id"])
    unknown = F.when(F.col("schema_id").isNotNull() & F.col("schema").isNull(), "unknown schema id")
    return with_errors(joined, unknown, on_error)


def latest_schema(registry: DataFrame) -> DataFrame:
    """The newest version of every subject."""
    newest = F.max_by(F.struct("version", "id", "format", "schema"), "version")
    return registry.groupBy("subject").agg(newest.alias("s")).select("subject", "s.*")


def subject_of(topic: str, side: str = "value") -> str:
    """Registry subject of a topic's keys or values."""
    return f"{topic}-{side}"


def register_schema(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Add the subjects that do not exist yet; existing ones are left as they are."""
    return registry.unionByName(new.join(registry.select("subject"), "subject", "left_anti").select(registry.columns))


def sync_registry(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target registry with every missing (subject, version) of the source, ids kept."""
    missing = source.join(target.select("subject", "version"), ["subject", "version"], "left_anti")
    return target.unionByName(missing.select(target.columns))


_RECORD_FIELDS = "struct<type:string,name:string,fields:array<struct<name:string,type:string,default:string>>>"


def schema_fields(registry: DataFrame) -> DataFrame:
    """One row per field of every record schema: ``subject, version, field, type, has_default``."""
    fields = F.from_json("schema", _RECORD_FIELDS)["fields"]
    # from_json cannot tell an absent default from a null one; the raw member names can
    raw = F.from_json(F.get_json_object("schema", "$.fields"), "array<string>")
    named = F.transform(
        fields,
        lambda f, i: F.struct(
            f["name"].alias("field"),
            f["type"].alias("type"),
            F.array_contains(F.json_object_keys(F.get(raw, i)), "default").alias("has_default"),
        ),
    )
    return registry.select("subject", "version", F.explode(named).alias("f")).select("subject", "version", "f.*")


def backward_compatible(old: DataFrame, new: DataFrame) -> DataFrame:
    """Whether readers with the new schema can read old data, per subject.

    Both are field tables as of :func:`schema_fields`, with one version per subject.  A
    new field needs a default; a removed field is allowed; of a kept field, the reader must take
    every type the writer may have used: the same, a wider one, or a union that holds one of these.
    """
    unions = "array<string>"

    def branches(type_text: Column) -> Column:
        """The types of a union; a plain type is a union of one."""
        return F.when(type_text.startswith("["), F.from_json(type_text, unions)).otherwise(F.array(type_text))

    def takes(writer: Column) -> Column:
        accepted = F.array(writer)
        for narrow, targets in PROMOTIONS.items():
            accepted = F.when(writer == narrow, F.array(*[F.lit(t) for t in [narrow, *targets]])).otherwise(accepted)
        return F.arrays_overlap(branches(F.col("n.type")), accepted)

    wider = F.forall(branches(F.col("o.type")), takes)
    both = old.alias("o").join(
        new.alias("n"), (F.col("o.subject") == F.col("n.subject")) & (F.col("o.field") == F.col("n.field")), "full"
    )
    problem = (
        F.when(F.col("n.field").isNull(), False)
        .when(F.col("o.field").isNull(), ~F.col("n.has_default"))
        .otherwise(~((F.col("o.type") == F.col("n.type")) | wider))
    )
    subject = F.coalesce(F.col("n.subject"), F.col("o.subject"))
    return both.groupBy(subject.alias("subject")).agg(
        F.sum(problem.cast("bigint")).alias("n_problems"), (~F.bool_or(problem)).alias("compatible")
    )


def compatibility_problems(old: DataFrame, new: DataFrame) -> DataFrame:
    """What keeps readers with the new schema from old data: a row for each place, ``subject, path, problem``.

    Both have ``subject`` and ``schema``, one version per subject.  Schemas are resolved to their whole depth: records by field
    names and aliases, arrays, maps, unions, enum symbols, fixed sizes, promotions and named types
    (:func:`tidemill.functions.compatibility.problems`).  Subjects without a problem have no row; neither have those
    that only one side knows.
    """
    pairs = old.select("subject", F.col("schema").alias("old")).join(new.select("subject", F.col("schema").alias("new")), "subject")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["subject"], *p) for r in batch.to_pylist() for p in problems(r["old"], r["new"])]
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["subject", "path", "problem"])

    return pairs.mapInArrow(run, "subject string, path string, problem string")


# -- typed payloads --------------------------------------------------------------------------


def struct_of_avro(schema: str | dict | list) -> T.DataType:
    """The Spark type of an Avro schema: records, arrays, maps, enums, fixed, named types, and unions (null and one
    type become that type, int and long a long, float and double a double, others one optional member each).
    ``ValueError`` for a type that Spark lacks, such as a record that holds itself."""
    node = json.loads(schema) if isinstance(schema, str) and schema[:1] in '{["' else schema
    try:
        return _spark_type(node, {}, "")
    except RecursionError:
        raise ValueError("a record holds itself") from None


def _spark_type(node: object, names: B.Names, space: str, body: bool = False) -> T.DataType:
    """``body``: as a portable body writes it, where dates and times are texts."""
    node, space = B.named(node, names, space)
    if isinstance(node, list):
        real = B.branches(node)
        if len(real) == 1:
            return _spark_type(real[0], names, space, body)
        return T.StructType([T.StructField(f"member{i}", _spark_type(n, names, space, body)) for i, n in enumerate(real)])
    if isinstance(node, str):
        if node not in AVRO_TYPES:
            raise ValueError(f"unsupported type {node!r}")
        return AVRO_TYPES[node]
    if node.get("logicalType") in AVRO_TYPES:
        return T.StringType() if body and node["logicalType"] in B.TEXT_DATES else AVRO_TYPES[node["logicalType"]]
    kind = node["type"]
    if kind == "record":
        return T.StructType([T.StructField(f["name"], _spark_type(f["type"], names, space, body)) for f in node["fields"]])
    if kind == "array":
        return T.ArrayType(_spark_type(node["items"], names, space, body))
    if kind == "map":
        return T.MapType(T.StringType(), _spark_type(node["values"], names, space, body))
    if kind == "enum":
        return T.StringType()
    return T.BinaryType() if kind == "fixed" else _spark_type(kind, names, space, body)


def _usable(build: Callable[[], Column], spark: SparkSession) -> bool:
    try:
        spark.range(1).select(build()).schema  # noqa: B018  resolving it is the test
        return True
    except Exception:
        return False


def avro_decoder(spark: SparkSession) -> Callable[[Column, str], Column] | None:
    """``from_avro`` if the session has the Avro package, else ``None``."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro if _usable(lambda: from_avro(F.unhex(F.lit("00")), '"string"'), spark) else None


def avro_encoder(spark: SparkSession) -> Callable[[Column, str], Column] | None:
    """``to_avro`` if the session has the Avro package, else ``None``."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro if _usable(lambda: to_avro(F.lit("x"), '"string"'), spark) else None


def protobuf_decoder(
    spark: SparkSession, message: str, descriptor: bytes
) -> Callable[[Column, str], Column] | None:
    """``from_protobuf`` for one message type if the session has the package, else ``None``."""
    try:
        from pyspark.sql.protobuf.functions import from_protobuf
    except ImportError:
        return None

    def decode(body: Column, schema: str = "") -> Column:
        return from_protobuf(body, message, binaryDescriptorSet=descriptor)

    return decode if _usable(lambda: decode(F.unhex(F.lit(""))), spark) else None


def encode_rows(
    df: DataFrame, schema: str, encoder: Callable[[Column, str], Column] | None = None, out: str = "value"
) -> DataFrame:
    """Rows as payloads: Avro with an encoder, else the portable JSON body with null fields."""
    names = [f["name"] for f in json.loads(schema)["fields"]]
    row = F.struct(*names)
    body = encoder(row, schema) if encoder else F.to_json(row, BODY_OPTIONS).cast("binary")
    return df.withColumn(out, body).drop(*[n for n in names if n != out])


def json_decoder(body: Column, schema: str) -> Column:
    """The portable payload: a JSON body typed by the registered schema.

    Null for a body that is malformed or mistyped at any depth, has an unknown symbol, or lacks a field that has
    no default and is not nullable; ``from_json`` alone would give a row of nulls.
    """
    typed = struct_of_avro(schema)
    node = json.loads(schema) if schema[:1] in '{["' else schema
    if not isinstance(typed, T.StructType) or isinstance(node, list):
        return F.from_json(body.cast("string"), typed)
    checked = T.StructType([*_spark_type(node, {}, "", True).fields, T.StructField(_UNREAD, T.StringType())])
    parsed = F.from_json(body.cast("string"), checked, {"columnNameOfCorruptRecord": _UNREAD, "allowSingleQuotes": "false"})

    def whole(p: Column) -> Column:
        good = p[_UNREAD].isNull() & B.holds(p, node)
        return F.when(good, F.struct(*[_from_body(p[f.name], f.dataType).alias(f.name) for f in typed.fields]))

    return F.get(F.transform(F.array(parsed), whole), 0)


_UNREAD = "_unread"


def _from_body(value: Column, kind: T.DataType) -> Column:
    """A value as its body has it, with the texts of dates and times read."""
    dates = ("date", "timestamp")
    if not any(d in kind.simpleString() for d in dates):
        return value
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_from_body(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _from_body(v, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: _from_body(v, kind.valueType))
    return value.try_cast(kind) if any(kind.simpleString().startswith(d) for d in dates) else value


def decode_by_schema(
    df: DataFrame,
    registry: DataFrame,
    decoder: Callable[[Column, str], Column] = json_decoder,
    column: str = "value",
    on_error: str = "reject",
) -> Mapping[int, DataFrame]:
    """Framed records as one typed frame per schema id, with key, offsets and the payload's columns.

    Records without a frame, with an id outside the registry, or with a body that does not match its schema go to ``-1``
    with a message and their body.  A frame is planned when it is asked for, so a registry may have any size; each
    reads the input.  To read many of them land the bodies once (``sources.sinks.land_typed``).
    """
    return decode_bodies(unframe_records(df, column, "reject"), registry, decoder, column, on_error)


def decode_bodies(
    rows: DataFrame,
    registry: DataFrame,
    decoder: Callable[[Column, str], Column] = json_decoder,
    column: str = "value",
    on_error: str = "reject",
) -> Mapping[int, DataFrame]:
    """The same for rows that are unframed already (``schema_id``, body, ``_error``)."""
    return _Decoded(rows, registry, decoder, column, on_error)


class _Decoded(Mapping):
    """Frames by schema id, each made when it is asked for; JSON bodies are checked with schemas as data."""

    REJECTED = -1

    def __init__(self, rows: DataFrame, registry: DataFrame, decoder, column: str, on_error: str):
        self.registry = registry.select("id", "schema").distinct()
        self.decoder, self.column, self.fail = decoder, column, on_error == "fail"
        self.meta = [c for c in rows.columns if c not in (column, "schema_id", ERROR)]
        self.rows = check_bodies(rows, registry, column) if decoder is json_decoder else rows

    def __iter__(self) -> Iterator[int]:
        yield from (r["id"] for r in self.registry.toLocalIterator())
        yield self.REJECTED

    def __len__(self) -> int:
        return self.registry.count() + 1

    def _typed(self, sid: int, schema: str) -> DataFrame:
        good = self.rows.filter(F.col("schema_id") == sid) if self.fail else keep_where(
            self.rows, (F.col("schema_id") == sid) & F.col(ERROR).isNull()
        )
        return good.withColumn("_p", self.decoder(F.col(self.column), schema))

    def __getitem__(self, sid: int) -> DataFrame:
        if sid == self.REJECTED:
            return self._rejected()
        found = self.registry.filter(F.col("id") == sid).first()
        if found is None:
            raise KeyError(sid)
        typed = self._typed(sid, found["schema"])
        bad = F.when(F.col("_p").isNull(), MISMATCH)
        return with_errors(typed, bad, "fail" if self.fail else "drop", costly=True).select(*self.meta, "_p.*")

    def _rejected(self) -> DataFrame:
        if self.decoder is json_decoder:
            missing = F.when(F.col(ERROR).isNull() & F.col("schema_id").isNull(), "missing value")
            return keep_where(with_errors(self.rows, missing), F.col(ERROR).isNotNull())
        # binary bodies are told by their decoders, one for each schema
        schemas = {r["id"]: r["schema"] for r in self.registry.toLocalIterator()}
        known = F.col("schema_id").isin(list(schemas)) if schemas else F.lit(False)
        reason = F.when(F.col("schema_id").isNull(), "missing value").when(~known, "unknown schema id")
        odd = with_errors(self.rows, reason)
        odd = odd.filter(F.col(ERROR).isNotNull())
        mismatched = (
            keep_where(self._typed(sid, s), F.col("_p").isNull()).withColumn(ERROR, F.lit(MISMATCH)).drop("_p") for sid, s in schemas.items()
        )
        return reduce(lambda x, y: x.unionByName(y), mismatched, odd)


def check_bodies(rows: DataFrame, registry: DataFrame, column: str = "value") -> DataFrame:
    """Unframed JSON bodies against the schemas of their ids, to their whole depth; ``_error`` tells what does not match.

    Schemas are data here, one row each, joined by id: the plan is the same for any number of them.  Records,
    arrays, maps, enums, unions and named types are followed (:mod:`tidemill.functions.bodies`); a field may be absent or null if
    it has a default or takes null; members that the schema does not have are ignored.  What passes here is read
    with all its values by :func:`json_decoder`.
    """
    by_id = registry.groupBy(F.col("id").alias("schema_id")).agg(F.min("schema").alias("_schema"))
    joined = lookup_join(rows, by_id, ["schema_id"])
    judged = joined.withColumn("_fits", _fits(F.col("_schema"), F.col(column).cast("binary")))
    error = (
        F.when(F.col(column).isNull() & F.col(ERROR).isNull(), "missing value")
        .when(F.col("schema_id").isNotNull() & F.col("_schema").isNull(), "unknown schema id")
        .when(~F.col("_fits"), MISMATCH)
    )
    return with_errors(judged, error, "reject").drop("_schema", "_fits")


@F.arrow_udf(T.BooleanType())
def _fits(schemas: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for schema, body in schemas:
        # rows of one schema share one text, however often it came
        coded = schema.dictionary_encode()
        texts, codes = coded.dictionary.to_pylist(), coded.indices.to_pylist()
        pairs = zip((None if c is None else texts[c] for c in codes), body.to_pylist())
        yield pa.array(list(B.verdicts(pairs)), pa.bool_())


def decode_click(df: DataFrame, column: str = "value", on_error: str = "reject") -> DataFrame:
    """Clicks from JSON bodies with the defaults of absent fields; a zero time becomes now.

    A missing, malformed or mistyped body is an error and gets no defaults.
    """
    shape = f"user_id int, event_type string, ts_millis bigint, {_UNREAD} string"
    parsed = F.from_json(F.col(column).cast("string"), shape, {"columnNameOfCorruptRecord": _UNREAD})
    rows = df.withColumn("_c", parsed)
    error = F.when(F.col(column).isNull(), "missing value").when(
        F.col("_c").isNull() | F.col(f"_c.{_UNREAD}").isNotNull(), "not a click"
    )
    tagged = with_errors(rows, error, "reject")
    now = F.unix_micros(F.current_timestamp())
    at = F.coalesce(F.col("_c.ts_millis"), F.lit(CLICK_DEFAULTS["ts_millis"]).cast("bigint"))
    good = lambda value: F.when(F.col(ERROR).isNull(), value)
    out = tagged.withColumns(
        {
            "user_id": good(F.coalesce("_c.user_id", F.lit(CLICK_DEFAULTS["user_id"]))),
            "event_type": good(F.coalesce("_c.event_type", F.lit(CLICK_DEFAULTS["event_type"]))),
            "ts_millis": good(F.when(at == 0, now).otherwise(at)),
        }
    ).drop("_c")
    return with_errors(out, F.lit(None).cast("string"), on_error, costly=True)
