"""Operators configured by environment settings, read once when the plan is built."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tidemill.functions.text import is_true_word

# --- fixed values: setting names, by operator and argument ------------------------------
SETTINGS = {
    "regex_filter": {"PATTERN": "pattern", "MATCH_VALUE": "match_value"},
    "flatten_json": {"FLATTEN_DELIM": "delim"},
    "redact": {"CONFIG": "config"},
    "frame_records": {"SCHEMA_ID": "schema_id"},
    "convert_ts": {
        "TIMESTAMP_MODE": "mode",
        "TIMESTAMP_TARGET_TYPE": "target",
        "TIMESTAMP_STRING_FORMAT": "fmt",
    },
}
REQUIRED = {"PATTERN", "CONFIG", "SCHEMA_ID", "TIMESTAMP_TARGET_TYPE"}
# ----------------------------------------------------------------------------------------


def arguments_from(operator: str, environ: Mapping[str, str]) -> dict[str, object]:
    """The keyword arguments that the settings give an operator.

    A missing required setting is an error; other missing ones leave the default.
    """
    out: dict[str, object] = {}
    for name, argument in SETTINGS[operator].items():
        if name in environ:
            out[argument] = environ[name]
        elif name in REQUIRED:
            raise ValueError(f"setting {name} is required")
    if "match_value" in out:
        out["match_value"] = is_true_word(out["match_value"])
    if "schema_id" in out:
        out["schema_id"] = int(out["schema_id"])
    return out


def configured(fn: Callable[..., DataFrame], environ: Mapping[str, str]) -> Callable[[DataFrame], DataFrame]:
    """An operator with its settings filled in, for ``df.transform`` or a stream."""
    arguments = arguments_from(fn.__name__, environ)
    return lambda df: fn(df, **arguments)
