"""Points in time: reading them from typed columns, scaling, and strftime output."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.numbers import truncating_div

# --- fixed values -----------------------------------------------------------------------
#: ticks per second by precision word and short form
PRECISIONS = {
    "seconds": 1,
    "s": 1,
    "milliseconds": 1_000,
    "ms": 1_000,
    "microseconds": 1_000_000,
    "us": 1_000_000,
    "nanoseconds": 1_000_000_000,
    "ns": 1_000_000_000,
}
SECONDS_PER_DAY = 86_400
# ----------------------------------------------------------------------------------------

NANOS = 1_000_000_000
_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
# years 1 to 9999, what a Spark timestamp can print
_MIN_SECONDS, _MAX_SECONDS = -62_135_596_800, 253_402_300_799


@dataclass(frozen=True)
class Ticks:
    """A whole number of ticks since the epoch, ``per_second`` of them in a second."""

    value: Column
    per_second: int

    @property
    def seconds(self) -> Column:
        """Whole seconds, rounded down."""
        if self.per_second == 1:
            return self.value
        below = F.pmod(self.value, F.lit(self.per_second).cast("bigint"))
        return truncating_div(self.value - below, self.per_second)

    @property
    def nanos(self) -> Column:
        """Nanoseconds within the second, 0 to 999999999."""
        if self.per_second == 1:
            return F.when(self.value.isNotNull(), F.lit(0).cast("bigint"))
        return F.pmod(self.value, F.lit(self.per_second).cast("bigint")) * (NANOS // self.per_second)


def read_instant(col: Column, data_type: T.DataType, fmt: str | None = None) -> Ticks:
    """Ticks of a column: int = epoch seconds, long = epoch milliseconds, string = RFC 3339
    or ``fmt``, dates and timestamps by their type (wall-clock timestamps read as UTC)."""
    if isinstance(data_type, T.IntegerType):
        return Ticks(col.cast("bigint"), 1)
    if isinstance(data_type, T.LongType):
        return Ticks(col, 1_000)
    if isinstance(data_type, T.DateType):
        return Ticks(F.unix_date(col).cast("bigint") * SECONDS_PER_DAY, 1)
    if isinstance(data_type, T.TimestampType):
        return Ticks(F.unix_micros(col), 1_000_000)
    if isinstance(data_type, T.TimestampNTZType):
        return Ticks(utc_micros(col), 1_000_000)
    if isinstance(data_type, T.StringType):
        return Ticks(_nanos_of_text(col, fmt), NANOS)
    raise ValueError(f"unsupported type for a timestamp: {data_type.simpleString()}")


def utc_micros(col: Column) -> Column:
    """Epoch microseconds of a wall-clock timestamp read as UTC, in any session time zone."""
    spark = SparkSession.active()
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        col = F.convert_timezone(F.lit("UTC"), F.current_timezone(), col)
    return F.unix_micros(col.cast("timestamp"))


def _nanos_of_text(col: Column, fmt: str | None) -> Column:
    thousand = F.lit(1_000).cast("bigint")
    if fmt is None:
        # the cast reads six digits of the fraction, the last three are taken from the text
        at = F.unix_micros(F.when(col.rlike(_RFC3339), F.upper(col)).try_cast("timestamp"))
        tail = F.rpad(F.regexp_extract(col, r"\.[0-9]{6}([0-9]{1,3})", 1), 3, "0").cast("bigint")
        tail = F.when(F.length(col) > 26, tail).otherwise(F.lit(0).cast("bigint"))
        # what does not fit 64-bit nanoseconds is null, not a wrapped number
        return F.try_add(F.try_multiply(at, thousand), tail)
    if fmt == "%s":
        return F.try_multiply(F.trim(col).try_cast("bigint"), F.lit(NANOS).cast("bigint"))
    return F.try_multiply(F.unix_micros(F.try_to_timestamp(col, F.lit(parse_pattern(fmt)))), thousand)


def scale(ticks: Ticks, per_second: int) -> Column:
    """Ticks in another precision: narrowing truncates toward zero, an overflow is null."""
    if per_second == ticks.per_second:
        return ticks.value
    if per_second < ticks.per_second:
        return truncating_div(ticks.value, ticks.per_second // per_second)
    return F.try_multiply(ticks.value, F.lit(per_second // ticks.per_second).cast("bigint"))


def in_range(ticks: Ticks) -> Column:
    """Whether the instant lies in the years 1 to 9999."""
    return ticks.seconds.between(_MIN_SECONDS, _MAX_SECONDS)


def epoch_day(ticks: Ticks) -> Column:
    """The date whole days away from the epoch, truncated toward zero."""
    days = truncating_div(ticks.value, SECONDS_PER_DAY * ticks.per_second)
    return F.when(in_range(ticks), F.date_from_unix_date(days.cast("int")))


def micros_of_day(ticks: Ticks) -> Column:
    """Microseconds since that day's midnight UTC."""
    second = F.pmod(ticks.seconds, F.lit(SECONDS_PER_DAY).cast("bigint"))
    micro = truncating_div(ticks.nanos, 1_000)
    return F.when(in_range(ticks), second * 1_000_000 + micro)


# -- strftime --------------------------------------------------------------------------------

Piece = Callable[[Ticks, Column], Column]


def _java(pattern: str) -> Piece:
    return lambda ticks, ts: F.date_format(ts, pattern)


def _digits(places: int, dot: bool) -> Piece:
    def piece(ticks: Ticks, ts: Column) -> Column:
        text = F.substring(F.lpad(ticks.nanos.cast("string"), 9, "0"), 1, places)
        return F.concat(F.lit("."), text) if dot else text

    return piece


def _shortest_fraction(ticks: Ticks, ts: Column) -> Column:
    nine = F.lpad(ticks.nanos.cast("string"), 9, "0")
    return (
        F.when(ticks.nanos == 0, "")
        .when(ticks.nanos % 1_000_000 == 0, F.concat(F.lit("."), F.substring(nine, 1, 3)))
        .when(ticks.nanos % 1_000 == 0, F.concat(F.lit("."), F.substring(nine, 1, 6)))
        .otherwise(F.concat(F.lit("."), nine))
    )


def _blank_padded(pattern: str) -> Piece:
    return lambda ticks, ts: F.lpad(F.date_format(ts, pattern), 2, " ")


def _sequence(*names: str) -> Piece:
    return lambda ticks, ts: F.concat(*[SPECIFIERS[n](ticks, ts) if n in SPECIFIERS else F.lit(n) for n in names])


def _literal(text: str) -> Piece:
    return lambda ticks, ts: F.lit(text)


#: what each time item prints; the instants are UTC
SPECIFIERS: dict[str, Piece] = {
    "Y": _java("yyyy"),
    "C": lambda t, ts: F.substring(F.date_format(ts, "yyyy"), 1, 2),
    "y": _java("yy"),
    "m": _java("MM"),
    "b": _java("MMM"),
    "h": _java("MMM"),
    "B": _java("MMMM"),
    "d": _java("dd"),
    "e": _blank_padded("d"),
    "a": _java("EEE"),
    "A": _java("EEEE"),
    "w": lambda t, ts: (F.dayofweek(ts) - 1).cast("string"),
    "u": lambda t, ts: (F.weekday(ts) + 1).cast("string"),
    "G": lambda t, ts: F.lpad(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), 4, "0"),
    "V": lambda t, ts: F.lpad(F.weekofyear(ts).cast("string"), 2, "0"),
    "j": _java("DDD"),
    "H": _java("HH"),
    "k": _blank_padded("H"),
    "I": _java("hh"),
    "l": _blank_padded("h"),
    "M": _java("mm"),
    "S": _java("ss"),
    "p": _java("a"),
    "P": lambda t, ts: F.lower(F.date_format(ts, "a")),
    "f": _digits(9, dot=False),
    "3f": _digits(3, dot=False),
    "6f": _digits(6, dot=False),
    "9f": _digits(9, dot=False),
    ".f": _shortest_fraction,
    ".3f": _digits(3, dot=True),
    ".6f": _digits(6, dot=True),
    ".9f": _digits(9, dot=True),
    "Z": _literal("UTC"),
    "z": _literal("+0000"),
    ":z": _literal("+00:00"),
    "s": lambda t, ts: t.seconds.cast("string"),
}
SPECIFIERS["D"] = SPECIFIERS["x"] = _sequence("m", "/", "d", "/", "y")
SPECIFIERS["F"] = _sequence("Y", "-", "m", "-", "d")
SPECIFIERS["v"] = _sequence("e", "-", "b", "-", "Y")
SPECIFIERS["R"] = _sequence("H", ":", "M")
SPECIFIERS["T"] = SPECIFIERS["X"] = _sequence("H", ":", "M", ":", "S")
SPECIFIERS["r"] = _sequence("I", ":", "M", ":", "S", " ", "p")
SPECIFIERS["c"] = _sequence("a", " ", "b", " ", "e", " ", "T", " ", "Y")
SPECIFIERS["+"] = _sequence("F", "T_", "T", ".f", ":z")
SPECIFIERS["T_"] = _literal("T")
_PLAIN = {"%": "%", "n": "\n", "t": "\t"}
_TOKEN = re.compile(r"%(\.[369]?f|[369]f|:z|[A-Za-z+%])|([^%]+)", re.DOTALL)


def split_format(fmt: str) -> list[tuple[str, str]]:
    """A strftime format as ("item", name) and ("text", literal) parts.

    An unknown item, and a format without any time item, raise ``ValueError``: the
    latter would print the same text for every instant.
    """
    parts, at = [], 0
    while at < len(fmt):
        m = _TOKEN.match(fmt, at)
        if m is None:
            raise ValueError(f"invalid time format {fmt!r}")
        name, text = m.group(1), m.group(2)
        if text is not None:
            parts.append(("text", text))
        elif name in _PLAIN:
            parts.append(("text", _PLAIN[name]))
        elif name in SPECIFIERS:
            parts.append(("item", name))
        else:
            raise ValueError(f"unknown time item %{name} in {fmt!r}")
        at = m.end()
    if not any(kind == "item" for kind, _ in parts):
        raise ValueError(f"time format {fmt!r} prints no part of the time")
    return parts


def strftime(ticks: Ticks, fmt: str) -> Column:
    """The instant (in UTC) printed with a strftime format."""
    parts = split_format(fmt)
    ts = F.timestamp_micros(ticks.seconds * 1_000_000)
    texts = [SPECIFIERS[p](ticks, ts) if kind == "item" else F.lit(p) for kind, p in parts]
    return F.when(in_range(ticks), F.concat(*texts))


#: strftime items that can be parsed, as pattern letters
PARSE_LETTERS = {
    "Y": "yyyy", "y": "yy", "m": "MM", "b": "MMM", "h": "MMM", "B": "MMMM", "d": "dd", "j": "DDD",
    "H": "HH", "I": "hh", "M": "mm", "S": "ss", "p": "a", "z": "xx", ":z": "xxx",
    ".f": "[.SSSSSSSSS][.SSSSSS][.SSS]", ".3f": ".SSS", ".6f": ".SSSSSS", ".9f": ".SSSSSSSSS",
    "F": "yyyy-MM-dd", "T": "HH:mm:ss", "R": "HH:mm", "D": "MM/dd/yy",
    "+": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]xxx",
}


def parse_pattern(fmt: str) -> str:
    """The datetime pattern that reads what ``fmt`` prints.

    A text without an offset names no instant, so the format must hold one.
    """
    out, has_offset = [], False
    for kind, part in split_format(fmt):
        if kind == "text":
            out.append("'" + part.replace("'", "''") + "'" if re.search(r"[A-Za-z'\[\]{}#]", part) else part)
            continue
        if part not in PARSE_LETTERS:
            raise ValueError(f"%{part} cannot be parsed in {fmt!r}")
        has_offset = has_offset or part in ("z", ":z", "+")
        out.append(PARSE_LETTERS[part])
    if not has_offset:
        raise ValueError(f"time format {fmt!r} has no offset item")
    return "".join(out)


def normalise_epoch(col: Column) -> Column:
    """Epoch microseconds of a number whose unit is told by its size.

    Up to 1e11 it counts seconds (until the year 5138), up to 1e14 milliseconds,
    up to 1e17 microseconds, beyond that nanoseconds.
    """
    x = col.cast("bigint")
    size = F.abs(x)
    return (
        F.when(size < 100_000_000_000, x * 1_000_000)
        .when(size < 100_000_000_000_000, x * 1_000)
        .when(size < 100_000_000_000_000_000, x)
        .otherwise(truncating_div(x, 1_000))
    )
