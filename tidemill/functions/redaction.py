"""The scalar redaction functions and their registry.

A function is described by its parameters, a column builder, and what it does to a plain
string (used for renamed keys, which are known when the plan is built).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.numbers import format_fixed

#: column builder: (input text, parameters) -> output text, null where it fails
ColumnForm = Callable[[Column, Mapping[str, Any]], Column]
TextForm = Callable[[str, Mapping[str, Any]], str]


@dataclass(frozen=True)
class RedactionFunction:
    name: str
    parameters: Mapping[str, type]
    column: ColumnForm
    text: TextForm | None = None
    #: what is wrong with an input that gave null; ``None`` for a function that cannot fail
    failure: str | None = None

    def check(self, config: Mapping[str, Any]) -> None:
        """Raise ``ValueError`` naming every missing or mistyped parameter."""
        problems = []
        for key, kind in self.parameters.items():
            if key not in config:
                problems.append(f"{self.name}: parameter {key!r} is missing")
            elif type(config[key]) is not kind:  # a bool is no int here
                problems.append(f"{self.name}: parameter {key!r} must be {kind.__name__}")
        if problems:
            raise ValueError("; ".join(problems))


REGISTRY: dict[str, RedactionFunction] = {}


def register_function(
    name: str,
    column: ColumnForm,
    parameters: Mapping[str, type] | None = None,
    text: TextForm | None = None,
    failure: str | None = None,
) -> None:
    """Make a redaction function available to configurations by name."""
    REGISTRY[name] = RedactionFunction(name, dict(parameters or {}), column, text, failure)


def bind(config: Mapping[str, Any] | None) -> Callable[[Column], Column]:
    """The column form of a configured function, checked."""
    fn = _lookup(config)
    return lambda col: fn.column(col, config)


def failure_of(config: Mapping[str, Any]) -> str | None:
    """The message for an input on which the configured function gives null."""
    return _lookup(config).failure


def bind_text(config: Mapping[str, Any] | None) -> Callable[[str], str]:
    """The plain-string form of a configured function, checked."""
    fn = _lookup(config)
    if fn.text is None:
        raise ValueError(f"function {fn.name!r} cannot make a key")
    return lambda text: fn.text(text, config)


def _lookup(config: Mapping[str, Any] | None) -> RedactionFunction:
    name = (config or {}).get("function")
    if name not in REGISTRY:
        raise ValueError(f"unknown redaction function {name!r}")
    REGISTRY[name].check(config)
    return REGISTRY[name]


def _before_separator(col: Column, config: Mapping[str, Any]) -> Column:
    cells = F.split(col, f"\\Q{config['separator']}\\E", -1)
    return F.when(F.size(cells) == 2, F.concat(F.lit(config["replacement"] + config["separator"]), F.get(cells, F.lit(1))))


def _before_separator_text(text: str, config: Mapping[str, Any]) -> str:
    head, sep, tail = text.partition(config["separator"])
    if not sep or config["separator"] in tail:
        raise ValueError(f"{text!r} must hold one {config['separator']!r}")
    return config["replacement"] + sep + tail


def _camel(col: Column, config: Mapping[str, Any]) -> Column:
    upper = F.concat(F.lit(config["prefix"]), F.upper(F.substring(col, 1, 1)), F.substr(col, F.lit(2)))
    return F.when(F.length(col) > 0, upper)


def _camel_text(text: str, config: Mapping[str, Any]) -> str:
    if not text:
        raise ValueError("empty key")
    return config["prefix"] + text[0].upper() + text[1:]


def _x_digits(col: Column, config: Mapping[str, Any]) -> Column:
    keep = config["i"]
    # one character per UTF-8 byte, because the kept tail is counted in bytes
    raw = F.decode(F.encode(col, "UTF-8"), "ISO-8859-1")
    head = F.substr(raw, F.lit(1), F.length(raw) - keep)
    masked = F.concat(F.regexp_replace(head, "[0-9]", "X"), F.right(raw, F.lit(keep)))
    return F.when(F.octet_length(col) >= keep, F.decode(F.encode(masked, "ISO-8859-1"), "UTF-8"))


register_function(
    "replace",
    lambda c, p: F.when(c.isNotNull(), F.lit(p["replacement"])),
    {"replacement": str},
    lambda t, p: p["replacement"],
)
register_function(
    "replaceBeforeSeparator",
    _before_separator,
    {"replacement": str, "separator": str},
    _before_separator_text,
    "does not hold exactly one separator",
)
register_function(
    "truncateFloat64",
    lambda c, p: format_fixed(c.try_cast("double"), p["decimals"]),
    {"decimals": int},
    lambda t, p: f"{float(t):.{p['decimals']}f}",
    "not a number",
)
register_function("md5", lambda c, p: F.md5(c), text=lambda t, p: hashlib.md5(t.encode()).hexdigest())
register_function("sha1", lambda c, p: F.sha1(c), text=lambda t, p: hashlib.sha1(t.encode()).hexdigest())
register_function(
    "prepend", lambda c, p: F.concat(F.lit(p["prefix"]), c), {"prefix": str}, lambda t, p: p["prefix"] + t
)
register_function("camelPrepend", _camel, {"prefix": str}, _camel_text, "empty text")
register_function(
    "append", lambda c, p: F.concat(c, F.lit(p["suffix"])), {"suffix": str}, lambda t, p: t + p["suffix"]
)
register_function("x-digits", _x_digits, {"i": int}, failure="too short to mask")
