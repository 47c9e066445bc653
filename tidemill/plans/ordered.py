"""Order-dependent values over whole tables without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.plans.shared import materialize
from tidemill.plans.skew import HOT_ROWS, hot_keys, small_side, split_hot

SLICE, POS = "_slice", "_pos"
#: rows that one task sorts at most
ROWS_PER_SLICE = 10_000_000
_POS_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def slice_count(df: DataFrame) -> int:
    """Slices for an ordered layout: the shuffle partitions, or more if a slice would get
    more than :data:`ROWS_PER_SLICE` rows."""
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, -(-df.count() // ROWS_PER_SLICE))


def ordered_slices(df: DataFrame, order: Sequence, slices: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``; number the slices and the rows in each.

    ``order`` must end in a unique column: then a value shared by many rows is cut into
    several slices as well.  The result is checkpointed, because the slice bounds come
    from a sample and two runs need not agree on them.
    """
    n = slices or slice_count(df)
    rid = F.monotonically_increasing_id()
    spread = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = spread.withColumn("_rid", rid)
    return materialize(
        numbered.withColumn(SLICE, F.shiftright("_rid", _POS_BITS))
        .withColumn(POS, F.col("_rid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_rid")
    )


def with_global_index(df: DataFrame, order: Sequence, out: str = "row_index", slices: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the global order."""
    parts = ordered_slices(df, order, slices)
    # one row per slice: the number of slices is set above, so this table is tiny
    sizes = parts.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        parts.join(small_side(starts), SLICE)
        .withColumn(out, F.col("_start") + F.col(POS))
        .drop(SLICE, POS, "_start")
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``value`` of the next row of the same key in ``order`` (null on the last one).

    Keys of ordinary size use one window per key.  Rows of hot keys are range-partitioned by
    key *and* order, so that one key spreads over many tasks, and the slices are joined
    at their edges.
    """
    keys, order = list(keys), list(order)

    def by_window(part: DataFrame) -> DataFrame:
        return part.withColumn(out, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))

    hot = hot_keys(df, keys, rows)
    if hot is None:
        return by_window(df)
    hot_rows, cold_rows = split_hot(df, keys, hot)
    return by_window(cold_rows).unionByName(_next_across_slices(hot_rows, keys, order, value, out))


def _next_across_slices(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    parts = ordered_slices(df, [*keys, *order])
    me = F.struct(*[F.col(k) for k in keys])
    row = F.struct(me.alias("k"), F.col(value).alias("v"))
    inside = Window.partitionBy(SLICE).orderBy(POS)
    # first row of each slice, shifted to the slice before it: one row per slice
    edges = (
        parts.filter(F.col(POS) == 0)
        .select(SLICE, row.alias("_first"))
        .withColumn("_edge", F.lead("_first").over(Window.orderBy(SLICE)))
        .select(SLICE, "_edge")
    )
    following = F.coalesce(F.col("_next"), F.col("_edge"))
    return (
        parts.withColumn("_next", F.lead(row).over(inside))
        .join(small_side(edges), SLICE, "left")
        .withColumn(out, F.when(following["k"].eqNullSafe(me), following["v"]))
        .drop(SLICE, POS, "_next", "_edge")
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits each map task to ``n`` rows per key before the shuffle, so a hot
    key sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
