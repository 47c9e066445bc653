"""Portable (JSON) bodies against Avro schemas, to their whole depth.

Two forms of the same rules: :func:`checker` for schemas that come as data, one for each record, and
:func:`holds` as a Spark expression for a schema that is known when the plan is made.  Null and absent are the
same in a body.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Check = Callable[[object], bool]
Names = dict[str, object]

_DATE = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2})")
_TIMESTAMP = re.compile(
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?(Z|[+-](0[0-9]|1[0-7]):[0-5][0-9])?"
)
# --- fixed values -----------------------------------------------------------------------
INTEGERS = {"int": 32, "long": 64}
#: what may stand for a number that JSON cannot write
ODD_NUMBERS = {"NaN", "Infinity", "-Infinity"}
#: logical types whose bodies are ISO texts
TEXT_DATES = {"date": "date", "timestamp-millis": "time", "timestamp-micros": "time",
              "local-timestamp-millis": "time", "local-timestamp-micros": "time"}
# ----------------------------------------------------------------------------------------


def branches(node: object) -> list | None:
    """The types of a union other than null; int and long are one, float and double as well.  None for other types."""
    if not isinstance(node, list):
        return None
    real = [n for n in node if n != "null"]
    for kinds, wide in (({"int", "long"}, "long"), ({"float", "double"}, "double")):
        if len(real) > 1 and all(isinstance(n, str) for n in real) and set(real) <= kinds:
            return [wide]
    return real


def is_optional(field: dict) -> bool:
    """Whether a body may lack the field."""
    return "default" in field or takes_null(field["type"])


def takes_null(node: object) -> bool:
    return node == "null" or (isinstance(node, list) and "null" in node)


def named(node: object, names: Names, space: str = "") -> tuple[object, str]:
    """A type with names looked up, and the name space that holds inside it."""
    if isinstance(node, str):
        for name in (f"{space}.{node}" if space else node, node):
            if name in names:
                return names[name], space
        return node, space
    if isinstance(node, dict) and node.get("type") in ("record", "enum", "fixed"):
        name = node.get("name", "")
        space = name.rpartition(".")[0] or node.get("namespace", space)
        names[f"{space}.{name.rpartition('.')[2]}" if space else name] = node
    return node, space


def checker(schema: str) -> Check:
    """A function that tells whether a parsed body fits the schema; raises ``ValueError`` on an unreadable schema."""
    node = json.loads(schema) if schema[:1] in '{["' else schema
    try:
        return _check(node, {}, {}, "")
    except (KeyError, TypeError, AttributeError) as error:
        raise ValueError(f"unreadable schema: {error!r}") from error


def _whole(bits: int) -> Check:
    low, high = -(1 << bits - 1), 1 << bits - 1
    return lambda v: type(v) is int and low <= v < high


def _base64(value: object) -> bool:
    try:
        return isinstance(value, str) and base64.b64decode(value, validate=True) is not None
    except (binascii.Error, ValueError):
        return False


def _date(value: object) -> bool:
    got = isinstance(value, str) and _DATE.fullmatch(value[:10])
    if not got:
        return False
    year, month, day = map(int, got.groups())
    leap = year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)
    return year > 0 and 1 <= month <= 12 and 1 <= day <= [31, 28 + leap, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month - 1]


_SIMPLE: dict[str, Check] = {
    "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool),
    "string": lambda v: isinstance(v, str),
    "bytes": _base64,
    "fixed": _base64,
    **{kind: _whole(bits) for kind, bits in INTEGERS.items()},
    **{kind: lambda v: type(v) in (int, float) or (isinstance(v, str) and v in ODD_NUMBERS) for kind in ("float", "double")},
}
_TEXT_DATE: dict[str, Check] = {
    "date": lambda v: isinstance(v, str) and len(v) == 10 and _date(v),
    "time": lambda v: isinstance(v, str) and _TIMESTAMP.fullmatch(v) is not None and _date(v),
}


def _check(node: object, names: Names, made: dict[int, Check], space: str) -> Check:
    node, space = named(node, names, space)
    if isinstance(node, str):
        return _SIMPLE[node]
    if isinstance(node, list):
        own = [_check(n, names, made, space) for n in branches(node) or []]
        nullable = takes_null(node)
        if len(own) < 2:
            return lambda v: nullable if v is None else any(c(v) for c in own)

        def one_member(v: object) -> bool:
            if v is None:
                return nullable
            if not isinstance(v, dict):
                return False
            given = [c(v[f"member{i}"]) for i, c in enumerate(own) if v.get(f"member{i}") is not None]
            return given == [True] or (nullable and not given)

        return one_member
    if node.get("logicalType") in TEXT_DATES:
        return _TEXT_DATE[TEXT_DATES[node["logicalType"]]]
    kind = node["type"]
    if kind == "record":
        if id(node) not in made:  # a record may hold itself
            fields: list[tuple[str, bool, Check]] = []
            made[id(node)] = lambda v: isinstance(v, dict) and all(
                optional if v.get(name) is None else check(v[name]) for name, optional, check in fields
            )
            fields += [(f["name"], is_optional(f), _check(f["type"], names, made, space)) for f in node["fields"]]
        return made[id(node)]
    if kind in ("array", "map"):
        inner = node["items" if kind == "array" else "values"]
        check, nullable = _check(inner, names, made, space), takes_null(inner)
        fits = lambda v: nullable if v is None else check(v)
        if kind == "array":
            return lambda v: isinstance(v, list) and all(map(fits, v))
        return lambda v: isinstance(v, dict) and all(map(fits, v.values()))
    if kind == "enum":
        symbols = set(node["symbols"])
        return lambda v: isinstance(v, str) and v in symbols
    return _SIMPLE["fixed"] if kind == "fixed" else _check(kind, names, made, space)


def verdicts(pairs: Iterator[tuple[str | None, bytes | str | None]]) -> Iterator[bool | None]:
    """For each (schema, body) whether the body fits; none without a schema or body.  Schemas met lately are kept."""
    known: dict[str, Check | None] = {}
    for schema, body in pairs:
        if schema is None or body is None:
            yield None
            continue
        if schema not in known:
            if len(known) >= 1000:
                known.clear()
            try:
                known[schema] = checker(schema)
            except (ValueError, RecursionError):
                known[schema] = None
        check = known[schema]
        try:
            yield check is not None and check(json.loads(body))
        except (ValueError, RecursionError):  # no JSON, no UTF-8, or nested without end
            yield False


def holds(value: Column, node: object, names: Names | None = None, space: str = "") -> Column:
    """Whether a value that Spark has typed by the schema has all it must have: required members of records at
    every depth, items, symbols, one branch of a union.  Not for null values of the top."""
    names = {} if names is None else names
    node, space = named(node, names, space)
    yes = F.lit(True)

    def all_of(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a & b, conditions, yes)

    def item(inner: object) -> Callable[[Column], Column]:
        return lambda v: F.when(v.isNull(), takes_null(inner)).otherwise(holds(v, inner, names, space))

    if isinstance(node, str):
        return yes
    if isinstance(node, list):
        own = branches(node) or []
        if len(own) < 2:
            return holds(value, own[0], names, space) if own else yes
        parts = [(value[f"member{i}"], n) for i, n in enumerate(own)]
        n_given = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v, _ in parts])
        fine = all_of([v.isNull() | holds(v, n, names, space) for v, n in parts])
        return fine & ((n_given == 1) | (F.lit(takes_null(node)) & (n_given == 0)))
    if node.get("logicalType") in TEXT_DATES:
        shape = _DATE if TEXT_DATES[node["logicalType"]] == "date" else _TIMESTAMP
        return value.rlike(f"^(?:{shape.pattern})$") & F.substring(value, 1, 10).try_cast("date").isNotNull() & ~value.startswith("0000")
    kind = node["type"]
    if kind == "record":
        return all_of(
            [F.when(value[f["name"]].isNull(), is_optional(f)).otherwise(holds(value[f["name"]], f["type"], names, space)) for f in node["fields"]]
        )
    if kind == "array":
        return F.forall(value, item(node["items"]))
    if kind == "map":
        return F.forall(F.map_values(value), item(node["values"]))
    if kind == "enum":
        return value.isin(list(node["symbols"]))
    return yes if kind == "fixed" else holds(value, kind, names, space)
