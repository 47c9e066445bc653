"""Operators on JSON documents.  All are narrow; documents compare as objects, not as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import jsonx as J
from tidemill.functions.errors import keep_where, with_errors

#: name under which the record key is visible to expressions
KEY_TEXT = "_key_text"


def _parsed(df: DataFrame, column: str) -> tuple[DataFrame, Column]:
    return df.withColumn("_doc", J.parse(F.col(column))), F.col("_doc")


def _doc_error(column: str) -> Column:
    return F.when(F.col(column).isNull(), "missing value").when(F.col("_doc").isNull(), "invalid JSON")


def _object_error(column: str) -> Column:
    return F.coalesce(_doc_error(column), F.when(J.members(F.col("_doc")).isNull(), "not a JSON object"))


def _settled(df: DataFrame, on_error: str) -> DataFrame:
    """Apply the policy to messages that are there already, without parsing again."""
    return with_errors(df, F.lit(None).cast("string"), on_error, costly=True)


def flatten_json(
    df: DataFrame,
    column: str = "value",
    delim: str = ".",
    max_depth: int | None = None,
    on_error: str = "reject",
) -> DataFrame:
    """Nested objects as one level of ``a<delim>b`` keys.

    Scalars, arrays, nulls and empty objects keep their place; records with an empty value
    are skipped.  With ``max_depth``, what is nested deeper stays nested.  A document that
    is no object is an error.
    """
    rows = df.filter(F.col(column).isNotNull() & (F.octet_length(column) > 0))
    rows, doc = _parsed(rows, column)
    # the check needs the parsed document only, so a filter on it does not flatten twice
    tagged = with_errors(rows, F.when(J.members(doc).isNull(), "not a JSON object"), on_error, costly=True)
    pairs = J.flat_entries(doc, delim, max_depth, F.col(column).cast("string"))
    return tagged.withColumn(column, J.object_text(pairs)).drop("_doc")


def json_paths(
    df: DataFrame, column: str = "value", delim: str = ".", max_depth: int | None = None, on_error: str = "reject"
) -> DataFrame:
    """One row per leaf: the other columns, ``path``, ``type`` and ``leaf`` (JSON text).

    A missing or malformed document, and one that is no object, is an error; ``reject`` keeps
    it as one row with its text in ``leaf``, no path, and the message.
    """
    rows, doc = _parsed(df, column)
    tagged = with_errors(rows, _object_error(column), "reject")
    leaf = lambda path, kind, text: F.struct(path.alias("path"), kind.alias("type"), text.alias("leaf"))
    none = F.lit(None).cast("string")
    pairs = J.flat_entries(doc, delim, max_depth, F.col(column).cast("string"))
    leaves = F.transform(pairs, lambda e: leaf(e["key"], J.type_name(e["value"]), F.to_json(e["value"])))
    rejected = F.array(leaf(none, none, F.col(column).cast("string")))
    found = tagged.withColumn("_leaf", F.explode(F.when(F.col("_error").isNull(), leaves).otherwise(rejected)))
    done = found.select(*[c for c in df.columns if c not in (column, "_error")], "_leaf.*", "_error")
    return _settled(done, on_error)


def flatten_struct(df: DataFrame, delim: str = ".", columns: Sequence[str] | None = None) -> DataFrame:
    """Nested struct columns as delimited flat columns; free of data cost."""
    wanted = set(df.columns if columns is None else columns)

    def walk(col: Column, data_type: T.DataType, name: str) -> list[Column]:
        if not isinstance(data_type, T.StructType):
            return [col.alias(name)]
        return [c for f in data_type.fields for c in walk(col[f.name], f.dataType, f"{name}{delim}{f.name}")]

    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        out += walk(col, f.dataType, f.name) if f.name in wanted else [col]
    return df.select(*out)


def split_objects(df: DataFrame, column: str = "value", on_error: str = "reject") -> DataFrame:
    """One row per top-level object of a value that holds several.

    What is missing, and a piece that is no JSON object (also one with text glued to it), is an
    error; ``reject`` keeps the piece.
    """
    pieces = F.when(F.col(column).isNull(), F.array(F.lit(None).cast("string"))).otherwise(J.split_documents(F.col(column)))
    rows, _ = _parsed(df.withColumn(column, F.explode(pieces)), column)
    return _settled(with_errors(rows, _object_error(column), "reject").drop("_doc"), on_error)


def json_delete(df: DataFrame, paths: Sequence[str], column: str = "value", on_error: str = "reject") -> DataFrame:
    """Remove members by dotted path; absent ones are ignored."""
    rows, doc = _parsed(df, column)
    tagged = with_errors(rows, _doc_error(column), "reject")
    out = tagged.withColumn(column, F.to_json(J.without_paths(doc, list(paths)))).drop("_doc")
    return _settled(out, on_error)


def json_construct(
    df: DataFrame,
    fields: Mapping[str, str | Column],
    column: str = "value",
    key: str | None = "key",
    on_error: str = "reject",
) -> DataFrame:
    """Build a new object: each member from a path of the old one, or from a column expression.

    Expressions may use the record key as the text column :data:`KEY_TEXT`; the key itself
    stays.  Members that are absent become JSON null.
    """
    rows, doc = _parsed(df, column)
    if key is not None and key in df.columns:
        rows = rows.withColumn(KEY_TEXT, F.make_valid_utf8(F.col(key).cast("string")))
    members = [
        (J.at(doc, source) if isinstance(source, str) else source).alias(name) for name, source in fields.items()
    ]
    tagged = with_errors(rows, _doc_error(column), "reject")
    built = F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
    out = tagged.withColumn(column, F.when(F.col("_error").isNull(), built)).drop("_doc", KEY_TEXT)
    return _settled(out, on_error)


def json_filter(
    df: DataFrame, path: str, data_type: str, predicate, column: str = "value", on_error: str = "reject"
) -> DataFrame:
    """Keep records for which ``predicate(value at path)`` is true.

    Malformed documents are errors, not misses: ``reject`` keeps them with a message.
    """
    rows, doc = _parsed(df, column)
    tagged = with_errors(rows, _doc_error(column), "reject")
    judged = tagged.withColumn("_keep", F.col("_error").isNotNull() | predicate(J.at(doc, path, data_type))).drop("_doc")
    return _settled(keep_where(judged, F.col("_keep")).drop("_keep"), on_error)


def json_explode(df: DataFrame, path: str, column: str = "value", on_error: str = "reject") -> DataFrame:
    """One record per element of the array at ``path``, each with the same key.

    A missing or malformed document, and one without an array at ``path``, is an error;
    ``reject`` keeps the record as it came.  An empty array gives no records.
    """
    rows, doc = _parsed(df, column)
    rows = rows.withColumn("_items", J.at(doc, path, "array<variant>"))
    error = F.coalesce(_doc_error(column), F.when(F.col("_items").isNull(), f"no array at {path}"))
    tagged = with_errors(rows, error, "reject")
    texts = F.transform("_items", lambda v: F.to_json(v))
    whole = F.array(F.col(column).cast("string"))
    out = tagged.withColumn(column, F.explode(F.when(F.col("_error").isNull(), texts).otherwise(whole))).drop("_doc", "_items")
    return _settled(out, on_error)


def validate_json(df: DataFrame, column: str = "value", on_error: str = "reject") -> DataFrame:
    """Apply a failure policy to missing values and invalid JSON."""
    return with_errors(df, J.parse_error(F.col(column)), on_error)
