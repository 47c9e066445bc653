"""Operators on small fixtures."""

import base64
import gzip
import hashlib
import json
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.errors import error_counts, split_errors, with_errors
from tidemill.functions.redaction import REGISTRY, bind, bind_text, register_function
from tidemill.operators import csv_ops, documents, json_ops, keyed, limits, records, registry
from tidemill.operators.redact import BUILTIN_REDACTORS, compile_config, load_config, redact
from tidemill.operators.timestamps import Mode, convert_ts, derive_schema, parse_mode, parse_target

# -- redaction ---------------------------------------------------------------------------------

VECTORS = [
    ({"function": "replace", "replacement": "none"}, "Tideway 9", "none"),
    ({"function": "replaceBeforeSeparator", "replacement": "hidden", "separator": "@"}, "n.ohara@tide.example", "hidden@tide.example"),
    ({"function": "replaceBeforeSeparator", "replacement": "**", "separator": "/"}, "left/right", "**/right"),
    ({"function": "truncateFloat64", "decimals": 2}, "2.71828", format(2.71828, ".2f")),
    ({"function": "truncateFloat64", "decimals": 1}, "1e20", format(1e20, ".1f")),
    ({"function": "truncateFloat64", "decimals": 0}, "-9223372036854775808", format(-(2.0**63), ".0f")),
    ({"function": "md5"}, "quay 4", hashlib.md5(b"quay 4").hexdigest()),
    ({"function": "sha1"}, "quay 4", hashlib.sha1(b"quay 4").hexdigest()),
    ({"function": "prepend", "prefix": "pre-"}, "dock", "pre-" + "dock"),
    ({"function": "camelPrepend", "prefix": "old"}, "berth", "old" + "berth".capitalize()),
    ({"function": "append", "suffix": "-post"}, "dock", "dock" + "-post"),
    ({"function": "x-digits", "i": 3}, "+44 (20) 7946-0018", re.sub("[0-9]", "X", "+44 (20) 7946-0") + "018"),
    ({"function": "x-digits", "i": 2}, "34ñ", "XXñ"),
]


@pytest.mark.parametrize("config,given,wanted", VECTORS)
def test_function_vectors(one, config, given, wanted):
    assert one("s string", given).select(bind(config)(F.col("s"))).first()[0] == wanted
    if REGISTRY[config["function"]].text is not None:
        assert bind_text(config)(given) == wanted


@pytest.mark.parametrize(
    "config,given",
    [
        ({"function": "replaceBeforeSeparator", "replacement": "r", "separator": "@"}, "a@b@c"),
        ({"function": "replaceBeforeSeparator", "replacement": "r", "separator": "@"}, "abc"),
        ({"function": "truncateFloat64", "decimals": 1}, "abc"),
        ({"function": "camelPrepend", "prefix": "p"}, ""),
        ({"function": "x-digits", "i": 4}, "123"),
    ],
)
def test_function_failures(one, config, given):
    assert one("s string", given).select(bind(config)(F.col("s"))).first()[0] is None


@pytest.mark.parametrize(
    "config",
    [
        {},
        {"function": "nothing"},
        {"function": "replace"},
        {"function": "replace", "replacement": 1},
        {"function": "truncateFloat64", "decimals": "1"},
        {"function": "x-digits", "i": True},
    ],
)
def test_function_configs_are_checked(config):
    with pytest.raises(ValueError):
        bind(config)


def test_redaction_configs_are_checked():
    for conf in (
        {"redactions": [{"path": "a", "type": "unheard"}]},
        {"redactors": [{"name": "x", "type": "odd"}]},
        {"redactors": [{"name": "x", "type": "value"}]},
        {"redactors": [{"name": "x", "type": "key-value", "value": {"function": "md5"}}]},
    ):
        with pytest.raises(ValueError):
            compile_config(conf)
    assert [r["name"] for r in BUILTIN_REDACTORS] == ["drop", "clear", "redact", "redactEmailUsername", "truncate", "md5", "x-digits"]


SHIPMENT = {
    "number": 58,
    "carrier": {"code": "NL-7", "desk": "desk@carrier.example"},
    "stops": [{"port": "RTM", "day": 3}, {"port": "BHX", "day": 9}],
    "consignee": {
        "given": "Ines",
        "family": "Okafor",
        "quay": "Pier 12, north side",
        "gate": "G4",
        "depth": -11.37,
        "draft": -8.04,
        "radio": "VHF 16-72-0955",
    },
    "sealed": True,
}
SHIPMENT_RULES = {
    "redactions": [
        {"path": "carrier", "type": "drop"},
        {"path": "consignee.family", "type": "drop"},
        {"path": "consignee.given", "type": "clear"},
        {"path": "consignee.gate", "type": "redact"},
        {"path": "consignee.quay", "type": "md5"},
        {"path": "consignee.radio", "type": "x-digits"},
        {"path": "consignee.depth", "type": "truncate"},
        {"path": "consignee.draft", "type": "truncate"},
    ]
}
WANTED = {
    **{k: SHIPMENT[k] for k in ("number", "stops", "sealed")},
    "consignee": {
        "given": "",
        "gate": "REDACTED",
        "radio": "VHF XX-XX-0955",
        "hashedQuay": hashlib.md5(b"Pier 12, north side").hexdigest(),
        "truncatedDepth": float(format(-11.37, ".1f")),
        "truncatedDraft": -8.0,
    },
}


def test_order_document_as_text_and_as_struct(spark, one):
    df = one("key string, value string", "k", json.dumps(SHIPMENT))
    out = redact(df, SHIPMENT_RULES, on_error="fail").first()
    assert out["key"] == "k" and json.loads(out["value"]) == WANTED
    schema = spark.read.json(df.rdd.map(lambda r: r["value"])).schema
    typed = df.select("key", F.from_json("value", schema).alias("value"))
    done = redact(typed, SHIPMENT_RULES, on_error="drop")
    assert json.loads(done.select(F.to_json("value")).first()[0]) == WANTED
    names = done.schema["value"].dataType["consignee"].dataType.names
    assert names[-3:] == ["hashedQuay", "truncatedDepth", "truncatedDraft"]
    assert out["value"].index('"hashedQuay"') > out["value"].index('"radio"') and '"truncatedDraft":-8.0' in out["value"]
    assert "Python" not in plan_of(done)


def test_custom_and_overriding_redactors(one):
    conf = {
        "redactors": [
            {"name": "redact", "type": "value", "quote": True, "value": {"function": "replace", "replacement": "---"}},
            {"name": "one", "type": "value", "quote": False, "value": {"function": "replace", "replacement": "1"}},
        ],
        "redactions": [{"path": "a.b", "type": "redact"}, {"path": "c", "type": "one"}, {"path": "a.none", "type": "drop"}],
    }
    out = redact(one("value string", '{"a":{"b":"x","z":[1]},"c":"y"}'), conf).first()
    assert json.loads(out["value"]) == {"a": {"b": "---", "z": [1]}, "c": 1} and out["_error"] is None


def test_failed_records_do_not_leak(spark):
    rows = [('{"phone":"123"}',), ("{}",), ("{",), (None,), ('{"phone":null}',)]
    conf = {"redactions": [{"path": "phone", "type": "x-digits"}]}
    out = redact(spark.createDataFrame(rows, "value string"), conf).collect()
    assert [(r["value"], r["_error"]) for r in out] == [
        (None, "phone: too short to mask"),
        (None, "missing path phone"),
        (None, "invalid JSON"),
        (None, None),
        ('{"phone":"null"}', None),
    ]
    with pytest.raises(ValueError):
        redact(spark.createDataFrame([((1,),)], "value struct<a:int>"), conf)
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        redact(spark.createDataFrame(rows, "value string"), conf, on_error="fail").collect()


def test_new_functions_can_be_registered(one):
    register_function("shout", lambda c, p: F.upper(c), text=lambda t, p: t.upper())
    conf = {
        "redactors": [{"name": "s", "type": "key-value", "quote": True, "key": {"function": "shout"}, "value": {"function": "shout"}}],
        "redactions": [{"path": "a", "type": "s"}],
    }
    assert json.loads(redact(one("value string", '{"a":"x","b":1}'), conf).first()["value"]) == {"b": 1, "A": "X"}
    del REGISTRY["shout"]


def test_config_forms():
    text = json.dumps(SHIPMENT_RULES)
    packed = base64.b64encode(gzip.compress(text.encode())).decode()
    assert load_config(SHIPMENT_RULES) == load_config(text) == load_config(packed) == load_config(packed.encode()) == SHIPMENT_RULES


# -- JSON --------------------------------------------------------------------------------------

NESTED = [
    (
        '{"buoy":{"nr":17,"place":{"bay":"Lund","reef":null,"deep":"no"},"pings":[4,"a",8]}}',
        {"buoy.nr": 17, "buoy.place.bay": "Lund", "buoy.place.reef": None, "buoy.place.deep": "no", "buoy.pings": [4, "a", 8]},
    ),
    ('{"k:":1,"y":true,"out":{"p":{"q":{}}}}', {"k:": 1, "y": True, "out.p.q": {}}),
    ('{"out":{"n":1},"far":{"none":{}},"none":{},"out":{"n":2}}', {"out.n": 2, "far.none": {}, "none": {}}),
    ("{}", {}),
    ('{"a\\"b":{"c":"q\\"z"}}', {'a"b.c': 'q"z'}),
]


def test_flatten(spark):
    df = spark.createDataFrame([(d,) for d, _ in NESTED], "value string")
    got = [json.loads(r["value"]) for r in json_ops.flatten_json(df, on_error="drop").collect()]
    assert got == [w for _, w in NESTED]
    slash = json_ops.flatten_json(df.limit(1), delim="/", on_error="drop").first()
    assert "buoy/place/deep" in json.loads(slash["value"])


def test_flatten_goes_to_any_depth(one):
    deep = '{"a":' * 200 + '"}{"' + "}" * 200
    whole = json_ops.flatten_json(one("value string", deep), on_error="drop").first()["value"]
    assert json.loads(whole) == {".".join("a" * 200): "}{"}
    cut = json_ops.flatten_json(one("value string", deep), max_depth=2, on_error="drop").first()["value"]
    assert list(json.loads(cut)) == ["a.a.a"]


def test_flatten_keeps_repeated_flat_keys(one):
    out = json_ops.flatten_json(one("value string", '{"a.b":1,"a":{"b":2}}'), on_error="drop").first()["value"]
    assert sorted(json.loads(out, object_pairs_hook=list)) == [("a.b", 1), ("a.b", 2)]


def test_flatten_rejects_and_skips(spark):
    df = spark.createDataFrame([("[1]",), ("{",), ("",), (None,), ('{"a":1}',)], "value string")
    out = [(r["value"], r["_error"]) for r in json_ops.flatten_json(df).collect()]
    assert out == [(None, "not a JSON object"), (None, "not a JSON object"), ('{"a":1}', None)]


def test_json_paths(spark):
    df = spark.createDataFrame([(1, NESTED[0][0])], "id int, value string")
    got = {(r["path"], r["type"], r["leaf"]) for r in json_ops.json_paths(df).collect()}
    assert ("buoy.place.reef", "null", "null") in got and ("buoy.pings", "array", '[4,"a",8]') in got
    assert len(got) == 5


def test_json_edits(spark):
    df = spark.createDataFrame([(b"k", '{"foo":42,"mail":"a@b.example","items":[{"a":1},2]}')], "key binary, value string")
    assert json.loads(json_ops.json_delete(df, ["mail", "no.path"], on_error="drop").first()["value"]) == {"foo": 42, "items": [{"a": 1}, 2]}
    built = json_ops.json_construct(df, {"f": "foo", "k": F.col(json_ops.KEY_TEXT), "n": "nope"}, on_error="drop").first()
    assert json.loads(built["value"]) == {"f": 42, "k": "k", "n": None} and bytes(built["key"]) == b"k"
    pieces = json_ops.json_explode(df, "items").collect()
    assert [(bytes(r["key"]), r["value"]) for r in pieces] == [(b"k", '{"a":1}'), (b"k", "2")]
    assert json_ops.json_filter(df, "foo", "int", lambda v: v > 42, on_error="drop").count() == 0
    bad = spark.createDataFrame([("{",), (None,)], "value string")
    assert [r["_error"] for r in json_ops.json_filter(bad, "a", "int", lambda v: v > 0).collect()] == ["invalid JSON", "missing value"]


BAD = ["{broken", None, "[1]", '{"items":{"no":"array"}}', '{"items":[1]} junk', '{"items":[1]}{"items":[2]}', '{"items":[1]}']


def test_bad_documents_are_rejected_with_their_body(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(BAD)], "off int, value string")
    messages = {0: "invalid JSON", 1: "missing value", 2: "no array at items", 3: "no array at items", 4: "invalid JSON", 5: "invalid JSON"}
    got = json_ops.json_explode(df, "items")
    assert {r.off: r._error for r in got.collect() if r._error} == messages
    assert all(r.value == BAD[r.off] for r in got.collect() if r._error) and [r.value for r in got.collect() if not r._error] == ["1"]
    paths = {r.off: r._error for r in json_ops.json_paths(df).collect()}
    assert paths == {0: "invalid JSON", 1: "missing value", 2: "not a JSON object", 3: None, 4: "invalid JSON", 5: "invalid JSON", 6: None}
    pieces = [(r.off, r._error) for r in json_ops.split_objects(df).collect()]
    assert sorted(pieces, key=str) == sorted([(0, "invalid JSON"), (1, "missing value"), (2, "not a JSON object"), (3, None), (4, "invalid JSON"), (5, None), (5, None), (6, None)], key=str)
    for operator in (lambda **how: json_ops.json_explode(df, "items", **how), lambda **how: json_ops.json_paths(df, **how), lambda **how: json_ops.split_objects(df, **how)):
        dropped = operator(on_error="drop")
        assert "_error" not in dropped.columns and dropped.count() == operator().filter("_error IS NULL").count()
        with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
            operator(on_error="fail").collect()


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([("k", "{}")], "key string, value string")
    for out in (
        json_ops.json_delete(df, ["a"], on_error="drop"),
        json_ops.json_construct(df, {"a": "b"}, on_error="drop"),
        json_ops.json_filter(df, "a", "int", lambda v: v > 1, on_error="drop"),
        json_ops.json_explode(df, "a", on_error="drop"),
        json_ops.json_paths(df, on_error="drop"),
    ):
        assert plan_of(out).count("try_parse_json(concat([") <= 1 or plan_of(out).count("parse_json") <= 2


def test_strict_parsing(one):
    from tidemill.functions import jsonx

    for text, good in (("null", True), ('"x"', True), (" [1,[2],[3]] ", True), ("1],[2", False), ("1 2", False), ("{} {}", False), ("", False)):
        assert (one("t string", text).select(jsonx.parse(F.col("t")).isNotNull()).first()[0]) is good


def test_flatten_struct(spark):
    df = spark.createDataFrame([((1, (2, "x")), 3)], "a struct<b:int,c:struct<d:int,e:string>>, f int")
    flat = json_ops.flatten_struct(df)
    assert flat.columns == ["a.b", "a.c.d", "a.c.e", "f"] and tuple(flat.first()) == (1, 2, "x", 3)


# -- CSV ---------------------------------------------------------------------------------------


def test_csv_lines(spark):
    rows = [("k1", "fish,2\nsoup,12abc"), ("k2", "a,1,2\nb,x\n"), ("k3", "c,3\nd,99999999999999999999")]
    df = spark.createDataFrame(rows, "key string, value string")
    out = [(r["key"], r["value"], r["_error"]) for r in csv_ops.csv_lines_to_json(df).collect()]
    columns, quantity = "unexpected number of columns", "invalid quantity"
    assert out == [
        ("k1", '{"item":"fish","quantity":2}', None),
        ("k1", '{"item":"soup","quantity":12}', None),
        ("k2", None, columns),
        ("k2", None, quantity),
        ("k2", None, columns),
        ("k3", '{"item":"c","quantity":3}', None),
        ("k3", None, quantity),
    ]
    whole = csv_ops.csv_lines_to_json(df, on_error="drop", whole_record=True).collect()
    assert [r["key"] for r in whole] == ["k1", "k1"]


def test_csv_records(spark):
    rows = [("01/02/2024,$1.5,10,$1,$2,$3",), ("a,b",), ("01/02/2024,$1,x,$1,$2,$3",), (None,)]
    df = spark.createDataFrame(rows, "value string")
    out = csv_ops.csv_to_record(df).collect()
    assert out[0]["record"].asDict() == {"Date": "01/02/2024", "Last": "$1.5", "Volume": 10, "Open": "$1", "High": "$2", "Low": "$3"}
    assert [r["_error"] for r in out] == [None, "unexpected number of columns", "malformed field", "missing value"]
    assert [r["record"] is None for r in csv_ops.csv_to_record(df, on_bad="null").collect()] == [False, True, True, True]
    assert csv_ops.csv_to_record(df, on_bad="drop").count() == 1


# -- timestamps --------------------------------------------------------------------------------


def test_mode_and_target_grammar():
    assert parse_mode("KEY") == Mode("key") and parse_mode("value[myField]") == Mode("value", "myField")
    assert parse_mode("key[my-Cool-Key]") == Mode("key", "my-Cool-Key")
    for bad in ("", "junk", "key[]", "value[]", "junk[a]", "key[a"):
        with pytest.raises(ValueError):
            parse_mode(bad)
    assert parse_target("unix").argument == 1 and parse_target("Unix[NS]").argument == 10**9
    assert parse_target("Date").kind == "date" and parse_target("string[%Y]").argument == "%Y"
    for bad in ("", "date[]", "string", "string[]", "string[xxx]", "unix[xyz]", "date[x]"):
        with pytest.raises(ValueError):
            parse_target(bad)


def test_field_mode_and_derived_schema(spark):
    df = spark.createDataFrame([("k", (1704310686988, True)), ("n", None)], "key string, value struct<a:bigint,b:boolean>")
    out = convert_ts(df, "value[a]", "unix[s]")
    assert [r["value"] for r in out.collect()] == [(1704310686, True), None]
    assert derive_schema(df.schema, "value[a]", "string[%Y]").simpleString() == "struct<key:string,value:struct<a:string,b:boolean>>"
    assert derive_schema(df.schema, "key", "date").simpleString().startswith("struct<key:date")
    assert convert_ts(df, "value[zzz]", "unix").collect() == df.collect()
    for mode in ("value", "key[x]"):
        with pytest.raises(ValueError):
            convert_ts(df, mode, "unix")
        with pytest.raises(ValueError):
            derive_schema(df.schema, mode, "unix")
    with pytest.raises(ValueError):
        convert_ts(df.withColumn("value", F.lit(True)), "value", "unix")


def test_framed_long_to_framed_text(spark):
    body = spark.createDataFrame([("1704310686988",)], "value string")
    framed = registry.frame_records(body, 7)
    rows = registry.unframe_records(framed, on_error="drop").withColumn("value", F.col("value").cast("string").cast("bigint"))
    out = registry.frame_records(convert_ts(rows, "value", "string[%Y-%m-%dT%H:%M:%S%.fZ]"), 9).first()["value"]
    assert bytes(out) == b"\x00\x00\x00\x00\x09" + b"2024-01-03T19:38:06.988Z"


# -- records -----------------------------------------------------------------------------------


def test_regex_lines(spark):
    rows = [(None, b"mail me at joe@example.com"), (None, b"nothing here"), (b"joe@example.com", None)]
    df = spark.createDataFrame(rows, "key binary, value binary")
    pattern = r"\b[a-z]+@[a-z.]+\b"
    assert records.regex_filter(df, pattern, "yes").count() == 1
    assert records.regex_filter(df, pattern, "off").count() == 1
    assert records.regex_filter(df, pattern).first()["value"] is None


def test_error_policies(spark):
    df = spark.range(4)
    error = F.when(F.col("id") % 2 == 1, "odd")
    tagged = with_errors(df, error)
    good, bad = split_errors(tagged)
    assert good.count() == 2 and [r["_error"] for r in bad.collect()] == ["odd", "odd"]
    assert error_counts(tagged).first().asDict() == {"n_rows": 4, "n_failed": 2}
    for costly in (False, True):
        assert with_errors(df, error, "drop", costly).columns == ["id"]
        assert with_errors(df, error, "drop", costly).count() == 2
        with pytest.raises(Exception, match="odd"):
            with_errors(df, error, "fail", costly).collect()
    with pytest.raises(ValueError):
        with_errors(df, error, "ignore")


def test_filters_reach_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    out = convert_ts(events.select("event_id", "user_id", F.col("ts").alias("value")), "value", "unix").filter("user_id = 3")
    plan = plan_of(out)
    assert "EqualTo(user_id,3)" in plan and "props" not in plan and "Exchange" not in plan


def test_time_filters_reach_the_scan(spark, sf):
    from datetime import datetime

    events = spark.read.parquet(f"{sf}/events.parquet")
    for df in (records.since(events, "ts", 7, datetime(2024, 1, 30)), keyed.retain(events, 86400, datetime(2024, 1, 30), "ts")):
        assert "GreaterThanOrEqual(ts,2024-01-2" in plan_of(df)


def test_narrow_operators_do_not_shuffle(spark, sf):
    from tidemill.queries.base import event_records

    rec = event_records(spark, sf)
    frames = [
        json_ops.flatten_json(rec, on_error="drop"),
        json_ops.json_paths(rec),
        records.regex_filter(rec, "a", True),
        redact(rec, {"redactions": [{"path": "user.type", "type": "md5"}]}, on_error="drop"),
        csv_ops.csv_lines_to_json(rec),
    ]
    for df in frames:
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan and "MapInArrow" not in plan


# -- registry ----------------------------------------------------------------------------------


def test_registry_tables(spark):
    rows = [("a-value", 1, 1, "AVRO", '"string"'), ("a-value", 2, 2, "AVRO", '"long"'), ("b-value", 1, 1, "AVRO", '"string"')]
    reg = spark.createDataFrame(rows, registry.REGISTRY_SCHEMA)
    assert {(r["subject"], r["id"]) for r in registry.latest_schema(reg).collect()} == {("a-value", 2), ("b-value", 1)}
    new = spark.createDataFrame([("a-value", 1, 9, "AVRO", "x"), ("c-value", 1, 3, "AVRO", '"int"')], registry.REGISTRY_SCHEMA)
    assert {(r["subject"], r["id"]) for r in registry.register_schema(reg, new).collect()} == {("a-value", 1), ("a-value", 2), ("b-value", 1), ("c-value", 3)}
    ids = spark.createDataFrame([(2,), (99,), (None,)], "schema_id int")
    out = {r["schema_id"]: (r["schema"], r["_error"]) for r in registry.with_schema(ids, reg).collect()}
    assert out == {2: ('"long"', None), 99: (None, "unknown schema id"), None: (None, None)}
    assert registry.sync_registry(reg, reg.filter("version < 1")).count() == 3


def test_avro_schema_as_spark_type():
    schema = {
        "type": "record",
        "name": "R",
        "fields": [
            {"name": "a", "type": "int"},
            {"name": "b", "type": ["null", "string"], "default": None},
            {"name": "c", "type": {"type": "long", "logicalType": "timestamp-micros"}},
            {"name": "d", "type": {"type": "array", "items": "double"}},
            {"name": "e", "type": {"type": "record", "name": "S", "fields": [{"name": "x", "type": "boolean"}]}},
        ],
    }
    got = registry.struct_of_avro(json.dumps(schema)).simpleString()
    assert got == "struct<a:int,b:string,c:timestamp,d:array<double>,e:struct<x:boolean>>"
    unions = {'["int","string"]': "struct<member0:int,member1:string>", '["null","int","long"]': "bigint", '["float","double"]': "double"}
    assert all(registry.struct_of_avro(u).simpleString() == t for u, t in unions.items())
    assert registry.struct_of_avro('{"type":"enum","name":"E","symbols":["A"]}').simpleString() == "string"
    assert registry.struct_of_avro('{"type":"fixed","name":"F","size":4}').simpleString() == "binary"
    with pytest.raises(ValueError):
        registry.struct_of_avro('"odd"')


def test_bodies_that_do_not_match(spark):
    schema = '{"type":"record","name":"R","fields":[{"name":"k","type":"int"}]}'
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", schema)], registry.REGISTRY_SCHEMA)
    rows = spark.createDataFrame([(1, 0, b'{"k":5}'), (2, 0, b""), (3, 4, b"{}"), (6, 0, b"{broken"), (7, 0, b'{"k":"x"}'), (8, 0, b"{}")], "n int, sid int, value binary")
    framed = registry.frame_records(rows, F.col("sid")).drop("sid")
    framed = framed.unionByName(spark.createDataFrame([(4, None), (5, b"xx")], "n int, value binary"))
    frames = registry.decode_by_schema(framed, reg)
    assert {(r["n"], r["k"]) for r in frames[0].collect()} == {(1, 5)}
    bad = {r["n"]: (r["_error"], r["value"] and bytes(r["value"])) for r in frames[-1].collect()}
    mismatch = registry.MISMATCH
    assert bad == {
        2: (mismatch, b""), 3: ("unknown schema id", b"{}"), 4: ("missing value", None), 5: ("frame too short", None),
        6: (mismatch, b"{broken"), 7: (mismatch, b'{"k":"x"}'), 8: (mismatch, b"{}"),
    }


# -- keyed, limits, documents --------------------------------------------------------------------


def test_tombstones_and_keyless_records(spark):
    rows = [(b"a", b"1", 0), (b"a", None, 1), (b"b", b"2", 2), (None, b"x", 3), (None, None, 4), (b"a", b"3", 0)]
    df = spark.createDataFrame(
        [(k, v, "t", 1 if i == 5 else 0, o) for i, (k, v, o) in enumerate(rows)],
        "key binary, value binary, topic string, partition int, offset bigint",
    )
    assert sorted((r["partition"], r["offset"]) for r in keyed.compact(df).collect()) == [(0, 2), (0, 3), (0, 4), (1, 0)]
    assert keyed.compact(df, keep_tombstones=True).count() == 5


def test_listing_and_sql(spark, one):
    listing = limits.list_row(one("a int, b string", 1, None)).collect()
    assert [tuple(r) for r in listing] == [(0, "a", "1"), (1, "b", None)]
    assert limits.run_sql(spark, "SELECT id FROM {t}", t=spark.range(500)).count() == 500
    assert limits.run_sql(spark, "SELECT cast('x' AS binary) AS key", 1, ["key", "zzz"]).first()["key"] == "x"


def test_fixed_chunks_reach_the_end(spark):
    df = spark.createDataFrame([(1, "x" * 10), (2, "abcdefghijk"), (3, ""), (4, None), (5, "ab")], "id int, text string")
    got = [(r["id"], r["chunk"]) for r in documents.chunk_fixed(df, size=4, overlap=1).collect()]
    assert got == [(1, "xxxx"), (1, "xxxx"), (1, "xxxx"), (2, "abcd"), (2, "defg"), (2, "ghij"), (2, "jk"), (5, "ab")]
    with pytest.raises(ValueError):
        documents.chunk_fixed(df, size=4, overlap=4)


def test_recursive_chunks_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (2, None, "y"), (3, "", "z")], "id int, text string, tag string")
    out = documents.chunk_recursive(df, size=5, overlap=2)
    assert out.schema["id"].dataType == T.IntegerType()
    assert [(r["id"], r["tag"], r["chunk_no"], r["start"], r["chunk"]) for r in out.collect()][0] == (1, "x", 0, 0, "a b c")


def test_bodies_are_checked_against_schemas_as_data(spark):
    schema = json.dumps(
        {"type": "record", "name": "R", "fields": [
            {"name": "i", "type": "int"}, {"name": "u", "type": ["null", "string"]}, {"name": "d", "type": "double", "default": 0},
            {"name": "o", "type": {"type": "record", "name": "S", "fields": []}, "default": {}},
            {"name": "a", "type": {"type": "array", "items": "int"}, "default": []}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A"]}, "default": "A"},
        ]}
    )
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", schema), ("t", 1, 5, "AVRO", schema)], registry.REGISTRY_SCHEMA)
    bodies = {
        '{"i":1}': True, '{"i":1,"u":null,"d":2,"o":{"x":1},"a":[],"e":"A","more":9}': True, '{"i":1,"u":"x","d":2.5}': True,
        '{"u":"x"}': False, '{"i":1.5}': False, '{"i":"1"}': False, '{"i":3000000000}': False, '{"i":null}': False,
        '{"i":1,"u":2}': False, '{"i":1,"o":[]}': False, '{"i":1,"a":{}}': False, '{"i":1,"e":1}': False, "[1]": False, "": False,
    }
    rows = spark.createDataFrame([(b, b, s) for b in bodies for s in (0, 5, 6)], "b string, value string, schema_id int").withColumn("_error", F.lit(None).cast("string"))
    out = registry.check_bodies(rows, reg).collect()
    assert {(r.b, r._error is None) for r in out if r.schema_id != 6} == set(bodies.items())
    assert {r._error for r in out if r.schema_id == 6} == {"unknown schema id"} and all(r.value == r.b for r in out)


# -- bodies to their whole depth --------------------------------------------------------------

_DEEP = {
    "type": "record", "name": "R", "namespace": "n", "fields": [
        {"name": "a", "type": {"type": "record", "name": "A", "fields": [{"name": "x", "type": "int"}, {"name": "s", "type": "string", "default": ""}]}},
        {"name": "l", "type": {"type": "array", "items": "int"}},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}},
        {"name": "m", "type": ["null", {"type": "map", "values": ["null", "n.A"]}], "default": None},
        {"name": "u", "type": ["null", "long", "string"], "default": None},
        {"name": "q", "type": ["null", {"type": "array", "items": "E"}], "default": None},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}, "default": 0},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-micros"}, "default": 0},
        {"name": "b", "type": "bytes", "default": ""}, {"name": "f", "type": ["float", "double"], "default": 0.0},
    ],
}
_GOOD = {"a": {"x": 1}, "l": [1, 2], "e": "A"}
_CASES = [
    ({}, True), ({"a": {"x": "bad"}}, False), ({"a": {}}, False), ({"a": {"x": None}}, False), ({"a": {"x": 1, "s": None, "more": [1]}}, True),
    ({"a": []}, False), ({"a": {"x": 2**31}}, False), ({"a": {"x": -(2**31)}}, True), ({"a": {"x": True}}, False), ({"a": {"x": 1.0}}, False),
    ({"l": ["q"]}, False), ({"l": []}, True), ({"l": [None]}, False), ({"l": [1, [2]]}, False), ({"l": {}}, False), ({"e": "ZZZ"}, False), ({"e": 1}, False),
    ({"m": {"k": {"x": 1}, "n": None}}, True), ({"m": {"k": {"x": "1"}}}, False), ({"m": {"k": {}}}, False), ({"m": []}, False), ({"m": {}}, True),
    ({"u": {"member0": 5}}, True), ({"u": {"member0": None, "member1": "x"}}, True), ({"u": {"member0": 1, "member1": "x"}}, False),
    ({"u": {"member0": "x"}}, False), ({"u": {"member0": None, "member1": None}}, True), ({"u": 5}, False),
    ({"q": ["A", "B"]}, True), ({"q": ["A", "C"]}, False), ({"q": [None]}, False), ({"d": "2024-02-29"}, True), ({"d": "2023-02-29"}, False),
    ({"d": 5}, False), ({"t": "2024-01-01T00:00:00.000Z"}, True), ({"t": "2024-01-01T25:00:00Z"}, False), ({"t": "x"}, False), ({"t": 5}, False),
    ({"b": "AAEC"}, True), ({"f": 1}, True), ({"f": 1.5e300}, True), ({"f": "NaN"}, True), ({"f": "1"}, False), ({"f": {}}, False),
]


def test_bodies_are_checked_to_their_whole_depth(spark):
    """Landing (schemas as data) and reading (schema in the plan) give the same verdicts."""
    schema = json.dumps(_DEEP)
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", schema)], registry.REGISTRY_SCHEMA)
    bodies = [(i, 0, json.dumps({**_GOOD, **extra})) for i, (extra, _) in enumerate(_CASES)]
    n = len(bodies)
    bodies += [(n, 0, '{"a":{"x":1},"l":[1],"e":"A"'), (n + 1, 0, "[]"), (n + 2, 0, "{}"), (n + 3, 0, "null"), (n + 4, 0, "")]
    want = {i for i, (_, good) in enumerate(_CASES) if good}
    rows = spark.createDataFrame(bodies, "n int, schema_id int, value string").withColumn("_error", F.lit(None).cast("string"))
    landed = {r.n for r in registry.check_bodies(rows, reg).filter("_error IS NULL").collect()}
    read = {r.n for r in rows.filter(registry.json_decoder(F.col("value"), schema).isNotNull()).collect()}
    assert landed == want and read == want
    frames = registry.decode_bodies(rows, reg)
    assert set(frames) == {0, -1} and len(frames) == 2 and 9 not in frames
    assert {r.n for r in frames[0].collect()} == want
    assert {(r.n, r.value) for r in frames[-1].collect()} == {(i, b) for i, _, b in bodies if i not in want}


def test_written_bodies_fit_their_schema(spark):
    rows = spark.sql(
        "SELECT named_struct('x', 1, 's', 'é') AS a, array(1, 2) AS l, 'B' AS e, map('k', named_struct('x', 3, 's', 'y'), 'n', NULL) AS m, "
        "named_struct('member0', CAST(NULL AS bigint), 'member1', 'x') AS u, array('A') AS q, date'2024-02-29' AS d, "
        "timestamp'1999-12-31 23:59:59.123456' AS t, X'0001ff' AS b, CAST('NaN' AS double) AS f"
    )
    coded = registry.encode_rows(rows, json.dumps(_DEEP)).withColumns({"schema_id": F.lit(0), "_error": F.lit(None).cast("string")})
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", json.dumps(_DEEP))], registry.REGISTRY_SCHEMA)
    assert registry.check_bodies(coded, reg).first()["_error"] is None
    got, want = registry.decode_bodies(coded, reg)[0].first(), rows.first()
    assert {k: v for k, v in got.asDict(True).items() if k != "f"} == {k: v for k, v in want.asDict(True).items() if k != "f"}


def test_recursive_and_unreadable_schemas():
    from tidemill.functions.bodies import checker, verdicts

    schema = '{"type":"record","name":"L","fields":[{"name":"v","type":"int"},{"name":"next","type":["null","L"]}]}'
    chain = lambda n, last=1: '{"v":1,"next":' * n + f'{{"v":{last}}}' + "}" * n
    assert list(verdicts([(schema, chain(50)), (schema, chain(50, '"x"')), (schema, chain(100_000))])) == [True, False, False]
    assert list(verdicts([('{"type":"odd"}', "{}"), ("{", "{}"), (None, "{}"), ('"int"', "5"), ('"int"', b"\xff")])) == [False, False, None, True, False]
    with pytest.raises(ValueError):
        checker('{"type":"record"}')


# -- nested compatibility and message indexes ------------------------------------------------------


def _record(*fields, name="R", **more):
    return {"type": "record", "name": name, "fields": [dict(zip(("name", "type", "default"), f)) for f in fields], **more}


def test_nested_compatibility(spark):
    enum = lambda *s, **k: {"type": "enum", "name": "E", "symbols": list(s), **k}
    inner = lambda *f, **k: _record(("a", _record(*f, name="A", **k)))
    listed, mapped = (lambda t: _record(("l", {"type": "array", "items": t}))), (lambda t: _record(("m", {"type": "map", "values": t})))
    again = lambda t: _record(("v", t), ("next", ["null", "R"]))
    renamed = _record(("b", "int"))
    renamed["fields"][0]["aliases"] = ["a"]
    cases = [
        (inner(("x", "int")), inner(("x", "long")), []),
        (inner(("x", "long")), inner(("x", "int")), [("a.x", "long cannot be read as int")]),
        (inner(("x", "int")), inner(("x", "int"), ("y", "int")), [("a.y", "new field without a default")]),
        (inner(("x", "int")), inner(("x", "int"), ("y", ["null", "int"], None)), []),
        (inner(("x", "int"), ("y", "int")), inner(("x", "int")), []),
        (inner(("x", ["null", "int"])), inner(("x", "int")), [("a.x", "null cannot be read as int")]),
        (inner(("x", "int")), inner(("x", ["null", "long"])), []),
        (inner(("x", "string")), inner(("x", ["null", "int"])), [("a.x", "no branch takes string")]),
        (listed("int"), listed("double"), []),
        (listed({"type": "array", "items": "int"}), listed({"type": "array", "items": "string"}), [("l[][]", "int cannot be read as string")]),
        (mapped(enum("A", "B")), mapped(enum("A")), [("m{}", "unknown symbols B")]),
        (mapped(enum("A", "B")), mapped(enum("A", default="A")), []), (mapped(enum("A")), mapped(enum("B", "A")), []),
        (listed("int"), _record(("l", {"type": "map", "values": "int"})), [("l", "array cannot be read as map")]),
        (_record(("a", "int")), renamed, []), (renamed, _record(("a", "int")), [("a", "new field without a default")]),
        (again("int"), again("long"), []), (again("long"), again("int"), [("v", "long cannot be read as int")]),
        (_record(("u", ["null", _record(("x", "int"), name="X")])), _record(("u", ["null", _record(("x", "string"), name="X")])), [("u.x", "int cannot be read as string")]),
        (_record(("f", {"type": "fixed", "name": "F", "size": 4})), _record(("f", {"type": "fixed", "name": "F", "size": 8})), [("f", "size 4 cannot be read as 8")]),
        (_record(("x", "int"), name="Old"), _record(("x", "int"), name="New", aliases=["Old"]), []),
        (_record(("x", "int"), name="Old"), _record(("x", "int"), name="New"), [("", "record has another name")]),
        (_record(("a", _record(("x", "int"), name="A")), ("b", "A")), _record(("b", _record(("x", "int"), name="A"))), []),
        (_record(("t", {"type": "long", "logicalType": "timestamp-micros"})), _record(("t", "long")), []),
    ]
    sides = [spark.createDataFrame([(str(i), json.dumps(c[k])) for i, c in enumerate(cases)], "subject string, schema string") for k in (0, 1)]
    got = {}
    for r in registry.compatibility_problems(*sides).collect():
        got.setdefault(int(r.subject), []).append((r.path, r.problem))
    assert {i: got.get(i, []) for i in range(len(cases))} == {i: c[2] for i, c in enumerate(cases)}
    odd = spark.createDataFrame([("s", "{")], "subject string, schema string")
    assert [r.path for r in registry.compatibility_problems(odd, odd).collect()] == [""]


def _plain_varint(n):
    n, out = 2 * n, b""
    while n > 127:
        out, n = out + bytes([n % 128 + 128]), n // 128
    return out + bytes([n])


def test_message_indexes(spark):
    lists = [[], [0], [1], [0, 0], [5, 0, 63], [64], [8191, 8192], [2**31 - 1], list(range(100))]
    rows = spark.createDataFrame([(i, x, b"body%d" % i) for i, x in enumerate(lists)], "i int, x array<int>, value binary")
    framed = registry.frame_messages(rows, 9, F.col("x"))
    for r in framed.collect():
        want = b"\0" if r.x in ([], [0]) else _plain_varint(len(r.x)) + b"".join(map(_plain_varint, r.x))
        assert bytes(r.value) == b"\0\0\0\0\x09" + want + b"body%d" % r.i
    back = {r.i: (r.schema_id, r.message_indexes, bytes(r.value)) for r in registry.unframe_messages(framed, on_error="fail").collect()}
    assert back == {i: (9, x or [0], b"body%d" % i) for i, x in enumerate(lists)}
    odd = [b"", b"\x04\x02", b"\x80", b"\x01", b"\x02\x01", b"\xff\xff\xff\xff\xff\xff\x01"]
    framed = registry.frame_records(spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, value binary"), 9)
    assert {r.i: (r._error, bytes(r.value)) for r in registry.unframe_messages(framed).collect()} == {
        i: ("unreadable message indexes", x) for i, x in enumerate(odd)
    }


def test_message_indexes_are_read_once_and_not_beyond_their_list(spark):
    from tidemill.functions import wire

    rows = spark.createDataFrame([(b"\x06\x06\x00\x02" + b"x" * 50,), (b"\x02\x81\x81\x81\x81\x81\x81\x02x",), (b"\x01ab",), (b"\x04\x02",)], "value binary")
    read = rows.select(wire.read_message_indexes(F.col("value")).alias("r")).collect()
    assert [r["r"] and (r["r"]["indexes"], r["r"]["size"]) for r in read] == [([3, 0, 1], 4), None, None, None]
    framed = registry.frame_messages(rows, 3, F.array(F.lit(0), F.lit(2)))
    for policy in ("reject", "drop"):
        out = registry.unframe_messages(framed, on_error=policy)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("aggregate(") == 1 and out.count() == 4
