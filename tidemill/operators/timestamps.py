"""Timestamp conversion of keys, values or one of their fields."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import instants as I
from tidemill.functions.errors import with_errors


@dataclass(frozen=True)
class Mode:
    """Which part of a record is converted."""

    side: str  # "key" or "value"
    field: str | None = None


@dataclass(frozen=True)
class Target:
    """What it is converted to: ``unix`` / ``string`` / ``date`` / ``time``."""

    kind: str
    argument: str | int | None = None

    @property
    def data_type(self) -> T.DataType:
        return {"unix": T.LongType(), "string": T.StringType(), "date": T.DateType(), "time": T.LongType()}[self.kind]


def _word_and_argument(text: str) -> tuple[str, str | None]:
    m = re.fullmatch(r"([^\[]*)(?:\[(.*)\])?", text, re.DOTALL)
    if m is None:
        raise ValueError(f"cannot read {text!r}")
    word, argument = m.group(1).lower(), m.group(2)
    if argument is not None and not argument.strip():
        raise ValueError(f"empty brackets in {text!r}")
    return word, argument.strip() if argument is not None else None


def parse_mode(text: str) -> Mode:
    """``key``, ``value``, ``key[field]`` or ``value[field]``; the word ignores case."""
    word, field = _word_and_argument(text)
    if word not in ("key", "value"):
        raise ValueError(f"invalid mode {text!r}")
    return Mode(word, field)


def parse_target(text: str) -> Target:
    """``string[fmt]``, ``unix``, ``unix[precision]``, ``date`` or ``time``."""
    word, argument = _word_and_argument(text)
    if word in ("date", "time") and argument is None:
        return Target(word)
    if word == "unix":
        name = (argument or "seconds").lower()
        if name not in I.PRECISIONS:
            raise ValueError(f"invalid precision in {text!r}")
        return Target("unix", I.PRECISIONS[name])
    if word == "string" and argument is not None:
        I.split_format(argument)
        return Target("string", argument)
    raise ValueError(f"invalid target {text!r}")


def convert_column(col: Column, data_type: T.DataType, target: Target, fmt: str | None = None) -> Column:
    """The converted column; null where a value cannot be converted."""
    ticks = I.read_instant(col, data_type, fmt)
    if target.kind == "unix":
        return I.scale(ticks, target.argument)
    if target.kind == "date":
        return I.epoch_day(ticks)
    if target.kind == "time":
        return I.micros_of_day(ticks)
    return I.strftime(ticks, target.argument)


def convert_ts(
    df: DataFrame,
    mode: str = "value",
    target: str = "unix",
    fmt: str | None = None,
    on_error: str = "drop",
    key: str = "key",
    value: str = "value",
) -> DataFrame:
    """Convert the key or value column, or one field of it when that column is a struct.

    The conversion is chosen by the column's type when the plan is built.  Null
    passes through; the other column is left alone.
    """
    how, goal = parse_mode(mode), parse_target(target)
    name = key if how.side == "key" else value
    data_type = df.schema[name].dataType
    if how.field is None:
        if isinstance(data_type, T.StructType):
            raise ValueError(f"column {name!r} is a record: name a field, as in {how.side}[field]")
        source, source_type = df[name], data_type
    else:
        if not isinstance(data_type, T.StructType):
            raise ValueError(f"column {name!r} is no record, so it has no field {how.field!r}")
        if how.field not in data_type.names:
            return with_errors(df, F.lit(None).cast("string"), on_error)
        source, source_type = df[name][how.field], data_type[how.field].dataType
    # converted once, in a column of its own
    rows = df.withColumn("_new", convert_column(source, source_type, goal, fmt))
    out = F.col("_new")
    if how.field is not None:
        members = [(out if f.name == how.field else F.col(name)[f.name]).alias(f.name) for f in data_type.fields]
        out = F.when(F.col(name).isNotNull(), F.struct(*members))
    failed = F.when(source.isNotNull() & F.col("_new").isNull(), f"cannot convert to {goal.kind}")
    # the message needs the column before it is replaced
    tagged = with_errors(rows, failed, "reject").withColumn(name, out).drop("_new")
    parsed = isinstance(source_type, T.StringType)
    return with_errors(tagged, F.lit(None).cast("string"), on_error, costly=parsed)


def derive_schema(schema: T.StructType, mode: str, target: str, column: str | None = None) -> T.StructType:
    """The schema :func:`convert_ts` yields, without running it.  Field metadata, where a
    default would be kept, is removed from the converted field."""
    how, goal = parse_mode(mode), parse_target(target)
    name = column or how.side

    def changed(f: T.StructField) -> T.StructField:
        if how.field is None:
            if isinstance(f.dataType, T.StructType):
                raise ValueError(f"column {f.name!r} is a record: name a field")
            return T.StructField(f.name, goal.data_type, f.nullable)
        if not isinstance(f.dataType, T.StructType):
            raise ValueError(f"column {f.name!r} is no record")
        inner = [
            T.StructField(g.name, goal.data_type, g.nullable) if g.name == how.field else g for g in f.dataType.fields
        ]
        return T.StructField(f.name, T.StructType(inner), f.nullable, f.metadata)

    return T.StructType([changed(f) if f.name == name else f for f in schema.fields])
