"""Expressions over JSON documents held as text or as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"


def parse(text: Column) -> Column:
    """JSON text as VARIANT; null when it is not JSON, or has anything after its end.

    The parser by itself stops at the end of the first value.  Inside brackets whatever follows
    makes the text malformed, or a second element.
    """
    whole = text.cast("string")
    listed = F.try_parse_json(F.concat(F.lit("["), whole, F.lit("]")))

    def only(values: Column) -> Column:
        second = F.try_variant_get(values, "$[1]", "variant")
        return F.when(second.isNull(), F.try_variant_get(values, "$[0]", "variant"))

    # a text that closes the bracket and opens another one doesn't get past a brace
    escapes = whole.rlike(r"\]\s*,\s*\[") & F.try_parse_json(F.concat(F.lit('{"v":'), whole, F.lit("}"))).isNull()
    return F.when(~escapes, F.get(F.transform(F.array(listed), only), 0))


def parse_error(text: Column) -> Column:
    """A message for a missing or malformed document, else null."""
    return F.when(text.isNull(), "missing value").when(parse(text).isNull(), "invalid JSON")


def members(value: Column) -> Column:
    """An object's members as a map; null for anything that is no object."""
    return F.try_variant_get(value, "$", OBJECT)


def json_path(path: str) -> str:
    """``a.b`` as a JSON path; every part is quoted, so that any key works."""
    if path.startswith("$"):
        return path
    return "$" + "".join(f"['{part}']" for part in path.split("."))


def at(value: Column, path: str, data_type: str = "variant") -> Column:
    """The value at a dotted path; null when it is absent or of another type."""
    return F.try_variant_get(value, json_path(path), data_type)


def raw_text(value: Column) -> Column:
    """A scalar without quotes, an object or array as JSON text."""
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))


def flat_entries(value: Column, delim: str = ".", max_depth: int | None = None, text: Column | None = None) -> Column:
    """(key, value) pairs of an object with nested keys joined by ``delim``.

    All within the row: each step opens one nesting level, and a document without nested
    members left is passed on as it is.  Arrays, empty objects and what lies deeper
    than ``max_depth`` stay as they are.  The number of steps is the nesting of the document's ``text``.
    """

    def pair(key: Column, item: Column) -> Column:
        return F.struct(key.alias("key"), item.alias("value"), members(item).alias("inner"))

    def is_open(entry: Column) -> Column:
        return F.coalesce(F.size(entry["inner"]) > 0, F.lit(False))

    def descend(entry: Column) -> Column:
        nested = F.transform(
            F.map_entries(entry["inner"]), lambda e: pair(F.concat(entry["key"], F.lit(delim), e["key"]), e["value"])
        )
        return F.when(is_open(entry), nested).otherwise(F.array(entry))

    top = F.transform(F.map_entries(members(value)), lambda e: pair(e["key"], e["value"]))
    if max_depth is not None and max_depth < 1:
        return top
    steps = F.greatest(nesting(F.to_json(value) if text is None else text), F.lit(1))
    if max_depth is not None:
        steps = F.least(steps, F.lit(max_depth))
    return F.aggregate(
        F.sequence(F.lit(1), steps),
        top,
        lambda pairs, _: F.when(F.exists(pairs, is_open), F.flatten(F.transform(pairs, descend))).otherwise(pairs),
    )


def nesting(text: Column) -> Column:
    """How deep the objects of a JSON text are nested, or more.  Few braces are taken for the
    depth; where there are many they are followed, strings left out."""
    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', ""), "[^{}]+", "")
    walked = F.aggregate(
        F.split(bare, ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, c: F.struct(
            (s["now"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("now"),
            F.greatest(s["most"], s["now"] + F.when(c == "{", 1).otherwise(0)).alias("most"),
        ),
        lambda s: s["most"],
    )
    return F.when(braces <= 16, braces).otherwise(walked)


def quote(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.array(text))
    return F.when(text.rlike(r'["\\\x00-\x1f\x7f]'), F.substr(whole, F.lit(2), F.length(whole) - 2)).otherwise(
        F.concat(F.lit('"'), text, F.lit('"'))
    )


def object_text(pairs: Column) -> Column:
    """JSON text of (key, value) pairs in their order; repeated keys are kept."""
    def member(e: Column) -> Column:
        plain = F.concat(F.lit('"'), e["key"], F.lit('":'), F.to_json(e["value"]))
        one = F.to_json(F.create_map(e["key"], e["value"]))
        quoted = F.substr(one, F.lit(2), F.length(one) - 2)
        return F.when(e["key"].rlike(r'["\\\\\x00-\x1f\x7f]'), quoted).otherwise(plain)

    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, member), ","), F.lit("}"))


def type_name(value: Column) -> Column:
    """object / array / string / number / boolean / null of a VARIANT."""
    first = F.substr(F.to_json(value), F.lit(1), F.lit(1))
    return (
        F.when(F.is_variant_null(value), "null")
        .when(first == "{", "object")
        .when(first == "[", "array")
        .when(first == '"', "string")
        .when(first.isin("t", "f"), "boolean")
        .otherwise("number")
    )


def without_paths(value: Column, paths: list[str]) -> Column:
    """An object without the members at the given dotted paths."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
            if node is None:  # a parent is removed already
                break
        if node is not None:
            node[leaf] = None
    return _prune(value, tree)


def _prune(value: Column, tree: dict) -> Column:
    inner = members(value)
    gone = [k for k, sub in tree.items() if sub is None]
    deeper = {k: sub for k, sub in tree.items() if sub}
    out = F.map_filter(inner, lambda k, _: ~k.isin(gone)) if gone else inner
    if deeper:
        def step(k: Column, v: Column) -> Column:
            chain = F
            for name, sub in deeper.items():
                chain = chain.when(k == name, _prune(v, sub))
            return chain.otherwise(v)

        out = F.transform_values(out, step)
    return F.when(inner.isNotNull(), F.to_variant_object(out)).otherwise(value)


def split_documents(text: Column) -> Column:
    """The top-level objects of a text that holds several, as an array of texts.

    Strings are set aside first, so a brace inside one never splits.
    """
    mark = "\u001e"
    tokens = F.regexp_extract_all(
        text.cast("string"), F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++)'), F.lit(1)
    )
    cut = F.transform(
        tokens,
        lambda t: F.when(t.startswith('"'), t).otherwise(F.regexp_replace(t, r"\}\s*\{", "}" + mark + "{")),
    )
    return F.split(F.trim(F.array_join(cut, "")), mark)
