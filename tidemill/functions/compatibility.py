"""Whether data written with one Avro schema can be read with another, to the whole depth of both."""

from __future__ import annotations

import json
from collections.abc import Iterator

from tidemill.functions.bodies import Names, named

# --- fixed values -----------------------------------------------------------------------
#: widening allowed from the writer's to the reader's type
PROMOTIONS = {
    "int": ["long", "float", "double"],
    "long": ["float", "double"],
    "float": ["double"],
    "string": ["bytes"],
    "bytes": ["string"],
}
# ----------------------------------------------------------------------------------------
Problem = tuple[str, str]


def problems(writer: str, reader: str) -> list[Problem]:
    """(path, problem) for every place where the reader cannot take what the writer may have written.

    Paths join field names by dots, ``[]`` is an item of an array and ``{}`` a value of a map.  An unreadable schema is one
    problem at the root.
    """
    try:
        both = [json.loads(s) if s[:1] in '{["' else s for s in (writer, reader)]
        return list(_resolve(both[0], both[1], "", _Side(), _Side(), set()))
    except (ValueError, KeyError, TypeError, AttributeError) as error:
        return [("", f"unreadable schema: {type(error).__name__}")]


class _Side:
    """The named types of one schema, and the name space at hand."""

    def __init__(self, names: Names | None = None, space: str = ""):
        self.names, self.space = {} if names is None else names, space

    def at(self, node: object) -> tuple[object, _Side]:
        found, space = named(node, self.names, self.space)
        return found, _Side(self.names, space)


def _kind(node: object) -> str:
    """The bare kind of a type that is no union; logical types are read as what they stand for."""
    while isinstance(node, dict) and isinstance(node["type"], dict):
        node = node["type"]
    return node["type"] if isinstance(node, dict) else node


def _short(node: dict) -> str:
    return node["name"].rpartition(".")[2]


def _resolve(w: object, r: object, path: str, ws: _Side, rs: _Side, open_: set) -> Iterator[Problem]:
    (w, ws), (r, rs) = ws.at(w), rs.at(r)
    if isinstance(w, list):  # every branch may have been written
        for branch in w:
            yield from _resolve(branch, r, path, ws, rs, open_)
        return
    if isinstance(r, list):
        tried = [list(_resolve(w, branch, path, ws, rs, open_)) for branch in r]
        if all(tried):
            same = [t for t, branch in zip(tried, r) if _kind(rs.at(branch)[0]) == _kind(w)]
            # the branch of the same kind tells more than that none takes it
            yield from same[0] if len(same) == 1 else [(path, f"no branch takes {_kind(w)}")]
        return
    a, b = _kind(w), _kind(r)
    if a != b:
        if b not in PROMOTIONS.get(a, []):
            yield path, f"{a} cannot be read as {b}"
        return
    if a in ("record", "enum", "fixed") and not _same_name(w, r):
        yield path, f"{a} has another name"
    if a == "record":
        if (id(w), id(r)) not in open_:  # a record may hold itself
            yield from _fields(w, r, path, ws, rs, open_ | {(id(w), id(r))})
    elif a == "array":
        yield from _resolve(w["items"], r["items"], path + "[]", ws, rs, open_)
    elif a == "map":
        yield from _resolve(w["values"], r["values"], path + "{}", ws, rs, open_)
    elif a == "enum" and "default" not in r and (gone := sorted(set(w["symbols"]) - set(r["symbols"]))):
        yield path, f"unknown symbols {', '.join(gone)}"
    elif a == "fixed" and w["size"] != r["size"]:
        yield path, f"size {w['size']} cannot be read as {r['size']}"


def _same_name(w: dict, r: dict) -> bool:
    return _short(w) in {_short(r), *(x.rpartition(".")[2] for x in r.get("aliases", []))}


def _fields(w: dict, r: dict, path: str, ws: _Side, rs: _Side, open_: set) -> Iterator[Problem]:
    written = {f["name"]: f for f in w["fields"]}
    for f in w["fields"]:  # names are known from where they are first given, read or not
        _learn(f["type"], ws)
    for f in r["fields"]:
        place = f"{path}.{f['name']}" if path else f["name"]
        source = next((written[n] for n in [f["name"], *f.get("aliases", [])] if n in written), None)
        if source is not None:
            yield from _resolve(source["type"], f["type"], place, ws, rs, open_)
        else:
            _learn(f["type"], rs)
            if "default" not in f:
                yield place, "new field without a default"


def _learn(node: object, side: _Side) -> None:
    """Take in the named types that a type gives."""
    if isinstance(node, list):
        for n in node:
            _learn(n, side)
    elif isinstance(node, dict):
        _, inner = side.at(node)
        for part in ("items", "values", "type"):
            if isinstance(node.get(part), (dict, list)):
                _learn(node[part], inner)
        for f in node.get("fields", []):
            _learn(f["type"], inner)
