"""Keys that hold a large share of the rows, and broadcasts behind a size check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.shared import materialize

#: A key with this many rows is hot: more than one task should sort, however large the table.
HOT_ROWS = 5_000_000
#: Limits for a table that may be sent to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    rows: int = HOT_ROWS,
) -> DataFrame | None:
    """The keys with ``rows`` rows or more, or ``None`` if there are none.

    The counts are combined before the shuffle.  The keys are written to the shared folder and
    nothing of them comes to the driver.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counts.filter(F.col("_n") >= rows).select(*keys))
    return None if hot.isEmpty() else hot


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` as (rows of hot keys, all other rows); ``hot`` comes from :func:`hot_keys`."""
    small = small_side(hot)
    cond = _same(df, small, keys)
    return df.join(small, cond, "left_semi"), df.join(small, cond, "left_anti")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is proven small: counted, never estimated, and only up to the limit."""
    width = reduce(lambda a, b: a + b, [_octets(f) for f in df.schema.fields], F.lit(0))
    got = (
        df.select(width.alias("_b"))
        .limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_b"), F.lit(0)).alias("b"))
        .first()
    )
    return got["n"] <= rows and got["b"] <= size


def _octets(field: T.StructField) -> Column:
    """About how many bytes a value takes."""
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = 8 * F.size(col)
    elif isinstance(kind, T.AtomicType):
        size = F.lit(16)
    else:
        size = F.octet_length(F.to_json(F.struct(col.alias("v"))))
    return F.coalesce(size, F.lit(0)).cast("long") + 8


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it passed :func:`fits_broadcast`, else ``df`` as it is,
    which leaves the join to a shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    rows: int = HOT_ROWS,
    max_dim_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``fact`` to a table with one row per key, whatever the key's distribution.

    A ``dim`` proven small is broadcast.  Otherwise the rows of hot keys meet their partner
    rows by broadcast, if those are proven small, and are not shuffled; the rest is a plain
    equi-join.  On a stream, where keys cannot be counted, that is left to AQE.
    """
    keys = list(keys)
    if fits_broadcast(dim, max_dim_rows):
        return fact.join(F.broadcast(dim), keys, how)
    hot = None if fact.isStreaming else hot_keys(fact, keys, rows)
    if hot is None:
        return fact.join(dim, keys, how)
    hot_fact, cold_fact = split_hot(fact, keys, hot)
    hot_dim = dim.join(small_side(hot), keys, "left_semi")
    return cold_fact.join(dim, keys, how).unionByName(hot_fact.join(small_side(hot_dim), keys, how))
