"""Redaction of documents by a configuration of named redactors and paths."""

from __future__ import annotations

import base64
import binascii
import gzip
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import jsonx as J
from tidemill.functions.errors import first_error, with_errors
from tidemill.functions.redaction import bind, bind_text, failure_of

# --- fixed values: the built-in redactors -----------------------------------------------
BUILTIN_REDACTORS: list[dict[str, Any]] = [
    {"name": "drop", "type": "drop"},
    {"name": "clear", "type": "value", "quote": True, "value": {"function": "replace", "replacement": ""}},
    {"name": "redact", "type": "value", "quote": True, "value": {"function": "replace", "replacement": "REDACTED"}},
    {
        "name": "redactEmailUsername",
        "type": "value",
        "quote": True,
        "value": {"function": "replaceBeforeSeparator", "replacement": "redacted", "separator": "@"},
    },
    {
        "name": "truncate",
        "type": "key-value",
        "key": {"function": "camelPrepend", "prefix": "truncated"},
        "value": {"function": "truncateFloat64", "decimals": 1},
    },
    {
        "name": "md5",
        "type": "key-value",
        "quote": True,
        "key": {"function": "camelPrepend", "prefix": "hashed"},
        "value": {"function": "md5"},
    },
    {"name": "x-digits", "type": "value", "quote": True, "value": {"function": "x-digits", "i": 4}},
]
# ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Edit:
    """One compiled redaction: what becomes of the field at ``path``."""

    path: tuple[str, ...]
    drop: bool
    new_name: str | None = None  # set when the key changes too
    value: Callable[[Column], Column] | None = None
    quote: bool = True
    numeric: bool = False
    failure: str | None = None

    @property
    def dotted(self) -> str:
        return ".".join(self.path)


def load_config(source: Mapping | str | bytes) -> dict:
    """A configuration from a mapping, JSON or YAML text, or gzip + base64 of such text.

    YAML needs the yaml package; JSON is read without it.
    """
    if isinstance(source, Mapping):
        return dict(source)
    text = source.decode() if isinstance(source, bytes) else source
    try:
        text = gzip.decompress(base64.b64decode("".join(text.split()), validate=True)).decode()
    except (binascii.Error, ValueError, OSError, EOFError):
        pass  # plain text
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError as missing:
        raise ValueError("YAML configurations need the yaml package; give a dict or JSON") from missing
    return yaml.safe_load(text)


def compile_config(config: Mapping | str | bytes) -> list[Edit]:
    """Check a configuration and compile it.  User redactors override built-ins by name.

    Raises ``ValueError`` for unknown functions, redactor types and names, and for missing
    or mistyped parameters, before any job is started.
    """
    conf = load_config(config)
    redactors = {}
    for entry in [*BUILTIN_REDACTORS, *(conf.get("redactors") or [])]:
        redactors[entry["name"]] = _compile_redactor(entry)
    edits = []
    for redaction in conf.get("redactions") or []:
        name = redaction["type"]
        if name not in redactors:
            raise ValueError(f"redaction of {redaction['path']!r} names an unknown redactor {name!r}")
        edits.append(redactors[name](tuple(redaction["path"].split("."))))
    return edits


def _compile_redactor(entry: Mapping[str, Any]) -> Callable[[tuple[str, ...]], Edit]:
    kind, quote = entry.get("type"), bool(entry.get("quote", False))
    if kind == "drop":
        return lambda path: Edit(path, drop=True)
    if kind not in ("value", "key-value"):
        raise ValueError(f"redactor {entry.get('name')!r} has an unknown type {kind!r}")
    value = bind(entry.get("value"))
    numeric = entry["value"]["function"] == "truncateFloat64"
    failure = failure_of(entry["value"])
    if kind == "value":
        return lambda path: Edit(path, False, None, value, quote, numeric, failure)
    rename = bind_text(entry.get("key"))
    return lambda path: Edit(path, True, rename(path[-1]), value, quote, numeric, failure)


def redact(
    df: DataFrame, config: Mapping | str | bytes, column: str = "value", on_error: str = "reject"
) -> DataFrame:
    """Apply all redactions to one column; every other column passes through.

    A struct column is edited field by field.  Text, binary or VARIANT is treated as a
    JSON document of unknown shape and comes back as JSON text.  All values
    are computed from the original document, so redactions do not chain.
    """
    edits = _not_below_dropped(compile_config(config))
    data_type = df.schema[column].dataType
    known = data_type if isinstance(data_type, T.StructType) else None
    # document, old texts and new texts are computed in steps, each of them once
    doc = df[column] if known or isinstance(data_type, T.VariantType) else J.parse(df[column])
    rows = df.withColumn("_doc", doc)
    texts, news, errors = {}, {}, []
    if known is None:
        errors.append(F.when(F.col(column).isNotNull() & F.col("_doc").isNull(), "invalid JSON"))
    for i, edit in enumerate(edits):
        leaf = _leaf_text(F.col("_doc"), known, edit) if edit.value is not None else None
        if leaf is None:
            continue
        texts[f"_t{i}"] = leaf
        news[f"_n{i}"] = edit.value(F.col(f"_t{i}"))
        errors.append(F.when(F.col("_doc").isNotNull() & F.col(f"_t{i}").isNull(), f"missing path {edit.dotted}"))
        if edit.failure is not None:
            failed = F.col(f"_t{i}").isNotNull() & F.col(f"_n{i}").isNull()
            errors.append(F.when(failed, f"{edit.dotted}: {edit.failure}"))
    rows = rows.withColumns(texts).withColumns(news) if texts else rows
    tree = _tree_of(edits)
    out = _rebuild(F.col("_doc"), known, tree) if known else _rewrite(F.col("_doc"), tree)
    tagged = with_errors(rows, first_error(*errors), "reject")
    # a failed record must not leak its unredacted value
    hidden = F.when(F.col("_error").isNull(), out)
    done = tagged.withColumn(column, hidden).drop("_doc", *texts, *news)
    return with_errors(done, F.lit(None).cast("string"), on_error, costly=known is None)


def _not_below_dropped(edits: Sequence[Edit]) -> list[Edit]:
    gone = [e.path for e in edits if e.drop and e.new_name is None]
    return [e for e in edits if not any(len(g) < len(e.path) and e.path[: len(g)] == g for g in gone)]


def _tree_of(edits: Sequence[Edit]) -> dict[str, Any]:
    """Edits by path part; a leaf is (edit, its number)."""
    tree: dict[str, Any] = {}
    for i, edit in enumerate(edits):
        node = tree
        for part in edit.path[:-1]:
            node = node.setdefault(part, {})
        node[edit.path[-1]] = (edit, i)
    return tree


def _leaf_text(doc: Column, schema: T.StructType | None, edit: Edit) -> Column:
    """The text a redactor sees: a scalar without quotes, anything else as JSON."""
    if schema is None:
        return J.raw_text(J.at(doc, edit.dotted))
    leaf, leaf_type = doc, schema
    for part in edit.path:
        if not isinstance(leaf_type, T.StructType) or part not in leaf_type.names:
            raise ValueError(f"no field {edit.dotted!r} to redact")
        leaf, leaf_type = leaf[part], leaf_type[part].dataType
    return leaf.cast("string") if isinstance(leaf_type, T.AtomicType) else F.to_json(leaf)


def _rebuild(doc: Column, schema: T.StructType, tree: Mapping[str, Any]) -> Column:
    """A struct of known shape as one projection: kept, replaced and nested fields in place,
    renamed ones at the end (in place of a field that has the name already)."""
    renamed = {node[0].new_name: node for node in tree.values() if isinstance(node, tuple) and node[0].new_name}

    def new(node: tuple[Edit, int]) -> Column:
        made = F.col(f"_n{node[1]}")
        return made.cast("double") if node[0].numeric and not node[0].quote else made

    fields = []
    for f in schema.fields:
        node = tree.get(f.name)
        if f.name in renamed:
            continue
        if node is None:
            fields.append(doc[f.name].alias(f.name))
        elif isinstance(node, Mapping):
            nested = isinstance(f.dataType, T.StructType)
            fields.append((_rebuild(doc[f.name], f.dataType, node) if nested else doc[f.name]).alias(f.name))
        elif not node[0].drop:
            fields.append(new(node).alias(f.name))
    fields += [new(node).alias(name) for name, node in renamed.items()]
    if not fields:
        raise ValueError("the redactions leave an empty document")
    return F.when(doc.isNotNull(), F.struct(*fields))


def _rewrite(value: Column, tree: Mapping[str, Any]) -> Column:
    """JSON text of a document of unknown shape: drop, replace in place, descend, then append renamed
    members.  New values are written as they are, so that ``-92.0`` keeps its decimal."""
    inner = J.members(value)
    gone: list[str] = []
    replaced: dict[str, Callable[[Column], Column]] = {}
    appended: dict[str, Column] = {}
    for name, node in tree.items():
        if isinstance(node, Mapping):
            replaced[name] = lambda v, node=node: _rewrite(v, node)
            continue
        edit, number = node
        if edit.value is None:
            gone.append(name)
            continue
        # quoted text becomes a JSON string, bare text must be JSON itself
        made = F.col(f"_n{number}")
        new = J.quote(made) if edit.quote else F.when(J.parse(made).isNotNull(), made)
        new = F.coalesce(new, F.lit("null"))
        if edit.new_name is None:
            replaced[name] = lambda v, new=new: new
        else:
            gone.append(name)
            appended[edit.new_name] = new

    def text_of(entry: Column) -> Column:
        chain = F
        for name, make in replaced.items():
            chain = chain.when(entry["key"] == name, make(entry["value"]))
        return chain.otherwise(F.to_json(entry["value"])) if replaced else F.to_json(entry["value"])

    entries = F.map_entries(inner)
    if gone or appended:
        entries = F.filter(entries, lambda e: ~e["key"].isin([*gone, *appended]))
    members = F.transform(entries, lambda e: F.concat(J.quote(e["key"]), F.lit(":"), text_of(e)))
    if appended:
        last = [F.concat(J.quote(F.lit(name)), F.lit(":"), new) for name, new in appended.items()]
        members = F.concat(members, F.array(*last))
    whole = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    return F.when(inner.isNotNull(), whole).otherwise(F.to_json(value))
