"""Expressions: fixed vectors and comparisons with Python."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import instants as I
from tidemill.functions import jsonx as J
from tidemill.functions import text as X
from tidemill.functions import wire as W
from tidemill.functions.chunking import SEPARATORS, chunk_spans
from tidemill.functions.numbers import format_fixed, leading_int, truncating_div


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


# -- numbers -----------------------------------------------------------------------------------


@pytest.mark.parametrize("decimals", [0, 1, 2, 5])
def test_format_fixed_equals_c(spark, decimals):
    import random

    rng = random.Random(decimals)
    xs = [0.25, 0.35, 0.5, 1.5, 2.5, -74.870911, -92.021109, 3.141593, 0.0, -0.0, -0.04, 9.95, 0.95, 99.95, 1e15 + 0.5, 2.0**62]
    xs += [rng.uniform(-1000, 1000) for _ in range(500)] + [round(rng.uniform(-100, 100), 3) for _ in range(1500)]
    xs += [k / 8 for k in range(-100, 100)]
    got = values(spark, [(x,) for x in xs], "x double", "x", format_fixed(F.col("x"), decimals))
    assert [(x, y) for x, y in got if y != f"{x:.{decimals}f}"] == []


def test_format_fixed_without_a_number(spark):
    rows = [(float("nan"),), (float("inf"),), (None,), (float("-inf"),)]
    assert values(spark, rows, "x double", format_fixed(F.col("x"), 1)) == [(None,)] * 4


def test_integers(spark):
    rows = [("12abc", -1500), (" +7 ", 1500), ("x", -1), ("", 0), ("99999999999999999999", 999)]
    got = values(spark, rows, "s string, n bigint", leading_int(F.col("s")), truncating_div(F.col("n"), 1000))
    assert got == [(12, -1), (7, 1), (None, 0), (None, 0), (None, 0)]


# -- text --------------------------------------------------------------------------------------


def test_ascii_boundary(spark):
    pattern = X.ascii_boundaries(r"\ba@")
    rows = [("éa@b",), ("xa@b",), (" a@b",), ("a@b",)]
    assert values(spark, rows, "s string", F.col("s").rlike(pattern)) == [(True,), (False,), (True,), (True,)]
    assert X.ascii_boundaries(r"[\b]x\\b") == r"[\b]x\\b"


@given(st.text(alphabet="ab@ .-", max_size=20), st.sampled_from([X.EMAIL_PATTERN, "a@+b", r"ab\.", "x*a@", "a{2}b", r"\Ba@", "[ab]@-"]))
@settings(max_examples=200, deadline=None)
def test_required_text_is_in_every_match(text, pattern):
    if re.search(pattern, text):
        assert X.required_text(pattern) in text


def test_required_text_gives_up():
    for pattern in ("a|b", "(ab)", r"\x41bc", r"\Qa.b\E", r"[\]]a"):
        assert X.required_text(pattern) == ""


def test_mask_emails(spark):
    rows = [("write to joe.b@mail.example.com, or x@y",), ("no address",), (None,)]
    assert values(spark, rows, "s string", X.mask_emails(F.col("s"))) == [
        ("write to redacted@mail.example.com, or x@y",),
        ("no address",),
        (None,),
    ]


def test_entities_are_decoded_once(spark):
    rows = [("a &amp;lt; b &copy;&#8364;&#x20AC; &nope; & &#0; &#xD800;",), ("plain",), ("&amp;amp;&quot;",)]
    assert values(spark, rows, "s string", X.unescape_entities(F.col("s"))) == [
        ("a &lt; b ©€€ &nope; & &#0; &#xD800;",),
        ("plain",),
        ('&amp;"',),
    ]


def test_html_to_text(spark):
    page = '<html><head><style>p{}</style><script>var t="</p>";</script></head><!-- no <b> --><p>One<br>two\n &amp; three</p>'
    assert values(spark, [(page,)], "s string", X.html_to_text(F.col("s"))) == [("One two & three",)]


def test_money(spark):
    rows = [("$93.855",), ("93",), ("$x",), (None,)]
    got = values(spark, rows, "s string", X.money_to_decimal(F.col("s")).cast("string"))
    assert got == [("93.8550",), ("93.0000",), (None,), (None,)]


def test_true_words():
    assert [w for w in ("yes", "OK", "1", "True", "no", "0", "", None) if X.is_true_word(w)] == ["yes", "OK", "1", "True"]


# -- frames ------------------------------------------------------------------------------------


def test_frames(spark):
    rows = [(bytes.fromhex(h) if h is not None else None,) for h in ("000004D2BEEF", "00000004D2BEEF", "000000", "FF00000000", "00FFFFFFFF01", None)]
    got = values(spark, rows, "v binary", W.frame_id(F.col("v")), F.hex(W.frame_body(F.col("v"))), W.frame_error(F.col("v")))
    assert got[1] == (1234, "BEEF", None)
    assert got[2] == (None, None, "frame too short")
    assert got[3] == (None, None, "bad magic byte")
    assert got[4] == (-1, "01", None)
    assert got[5] == (None, None, None)
    again = values(spark, [(-1, b"\x01"), (1234, b""), (5, None)], "i int, b binary", F.hex(W.frame(F.col("i"), F.col("b"))))
    assert again == [("00FFFFFFFF01",), ("00000004D2",), (None,)]


# -- instants ----------------------------------------------------------------------------------

SECONDS, MILLIS, MICROS, NANOS = 1704310686, 1704310686988, 1704310686988762, 1704310686988762314
TIME = 70686988762


def converted(spark, value, data_type, target, fmt=None):
    from tidemill.operators.timestamps import convert_column, parse_target

    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", data_type)]))
    return df.select(convert_column(F.col("v"), data_type, parse_target(target), fmt)).first()[0]


INPUTS = {
    "int": (SECONDS, T.IntegerType(), SECONDS * 10**9),
    "long": (MILLIS, T.LongType(), MILLIS * 10**6),
    "timestamp": (dt.datetime(2024, 1, 3, 19, 38, 6, 988762, dt.timezone.utc), T.TimestampType(), MICROS * 1000),
    "local": (dt.datetime(2024, 1, 3, 19, 38, 6, 988762), T.TimestampNTZType(), MICROS * 1000),
    "text": ("2024-01-03T19:38:06.988762314Z", T.StringType(), NANOS),
    "offset": ("2024-01-03T21:08:06.988762314+01:30", T.StringType(), NANOS),
    "date": (dt.date(2024, 1, 3), T.DateType(), 19725 * 86400 * 10**9),
}


@pytest.mark.parametrize("name", INPUTS)
def test_conversion_matrix(spark, name):
    value, data_type, nanos = INPUTS[name]
    for unit, size in (("s", 10**9), ("ms", 10**6), ("us", 10**3), ("ns", 1)):
        assert converted(spark, value, data_type, f"unix[{unit}]") == nanos // size
    assert converted(spark, value, data_type, "time") == nanos // 1000 % 86_400_000_000
    assert converted(spark, value, data_type, "date") == dt.date(2024, 1, 3)
    assert converted(spark, value, data_type, "string[%Y-%m-%d]") == "2024-01-03"
    assert converted(spark, value, data_type, "string[%H:%M]") == ("00:00" if name == "date" else "19:38")


def test_fraction_is_as_long_as_needed(spark):
    fmt = "string[%Y-%m-%dT%H:%M:%S%.fZ]"
    assert converted(spark, MILLIS, T.LongType(), fmt) == "2024-01-03T19:38:06.988Z"
    assert converted(spark, SECONDS, T.IntegerType(), fmt) == "2024-01-03T19:38:06Z"
    assert converted(spark, INPUTS["text"][0], T.StringType(), "string[%+]") == "2024-01-03T19:38:06.988762314+00:00"


def test_before_the_epoch(spark):
    early = dt.datetime(1969, 12, 31, 23, 59, 59, 999000, dt.timezone.utc)
    assert converted(spark, early, T.TimestampType(), "date") == dt.date(1970, 1, 1)
    assert converted(spark, early, T.TimestampType(), "unix") == 0
    assert converted(spark, early, T.TimestampType(), "time") == 86_399_999_000
    assert converted(spark, early, T.TimestampType(), "string[%F %T%.3f]") == "1969-12-31 23:59:59.999"
    assert converted(spark, -1500, T.LongType(), "unix[s]") == -1


def test_unreadable_and_too_large(spark):
    for bad in ("yesterday", "2024-01-03", "2024-13-03T00:00:00Z", "2024-01-03T00:00:00"):
        assert converted(spark, bad, T.StringType(), "unix") is None
    assert converted(spark, 2**62, T.LongType(), "unix[ns]") is None
    assert converted(spark, 2**62, T.LongType(), "date") is None
    assert converted(spark, "03/01/2024 19:38 +0100", T.StringType(), "unix", "%d/%m/%Y %H:%M %z") == SECONDS - 3606


@given(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)))
@settings(max_examples=12, deadline=None)
def test_strftime_like_python(spark, when):
    for item in ("%Y-%m-%d %H:%M:%S", "%a %A %b %B %j %y %I %p %u %w %G %V"):
        assert converted(spark, when, T.TimestampNTZType(), f"string[{item}]") == when.strftime(item)


def test_formats_are_checked():
    for fmt in ("", "xxx", "%%", "%q", "100%"):
        with pytest.raises(ValueError):
            I.split_format(fmt)
    with pytest.raises(ValueError):
        I.parse_pattern("%Y-%m-%d")


def test_normalised_epoch(spark):
    rows = [(SECONDS,), (MILLIS,), (MICROS,), (NANOS,), (-MILLIS,)]
    got = values(spark, rows, "x bigint", I.normalise_epoch(F.col("x")))
    assert got == [(SECONDS * 10**6,), (MILLIS * 1000,), (MICROS,), (MICROS,), (-MILLIS * 1000,)]


# -- JSON --------------------------------------------------------------------------------------


def test_split_documents_ignores_braces_in_strings(spark):
    text = '{"a":"} {"} {"b":2}\n{"c":"x\\"} {"}'
    got = values(spark, [(text,)], "s string", J.split_documents(F.col("s")))
    assert got == [(['{"a":"} {"}', '{"b":2}', '{"c":"x\\"} {"}'],)]


# -- chunks ------------------------------------------------------------------------------------


@given(st.text(alphabet="ab \n", max_size=300), st.integers(2, 40), st.integers(0, 20))
@settings(max_examples=300, deadline=None)
def test_chunks_cover_the_text(text, size, overlap):
    overlap = min(overlap, size - 1)
    spans = chunk_spans(text, size, overlap)
    covered = [False] * len(text)
    for (lo, hi), following in zip(spans, [*spans[1:], None]):
        assert 0 < hi - lo <= size
        assert following is None or (following[0] >= lo and following[1] >= hi and hi - following[0] <= overlap)
        covered[lo:hi] = [True] * (hi - lo)
    assert all(c or ch.isspace() for c, ch in zip(covered, text))


def test_chunks_prefer_coarse_separators():
    text = "aaa bbb\n\nccc ddd eee\nfff"
    assert [text[a:b] for a, b in chunk_spans(text, 12, 0, SEPARATORS)] == ["aaa bbb", "ccc ddd eee", "fff"]
    assert chunk_spans("", 10, 2) == [] and chunk_spans("   ", 10, 2) == []
