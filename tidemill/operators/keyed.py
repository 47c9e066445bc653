"""Latest-per-key, retention, change logs and row history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.ordered import with_next
from tidemill.plans.skew import HOT_ROWS, lookup_join

PARTITION_KEY = ("topic", "partition", "key")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], reread: bool = True) -> DataFrame:
    """The last row of each key in ``order`` (which must be unique within a key).

    With one order column the newest place of each key is hash-aggregated from the narrow columns, and the
    rows at those places are kept by a hash join: no whole record is sorted, and as the place is part of
    the join key, a hot key spreads over all tasks.  The input is read twice; ``reread=False`` is for
    inputs that are costly to compute, and for several order columns: whole rows are then
    combined before the shuffle, so that a key with many rows sends one per task.
    """
    if reread and len(order) == 1 and not df.isStreaming:
        named = {k: f"_key{i}" for i, k in enumerate(keys)}
        newest = df.groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(F.max(order[0]).alias("_place"))
        pairs = [*named.items(), (order[0], "_place")]
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in pairs])
        return df.join(newest.hint("shuffle_hash"), same, "left_semi")
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*").select(*df.columns)


def compact(df: DataFrame, keep_tombstones: bool = False, keys: Sequence[str] = PARTITION_KEY) -> DataFrame:
    """Log compaction: the last record of a key *within each partition*; a null value is a
    tombstone and deletes its key.  Records without a key are not compacted away."""
    # a record without a key is a group of its own, so one scan and one shuffle do for all
    alone = df.withColumn("_alone", F.when(F.col("key").isNull(), F.col("offset")))
    kept = latest_by_key(alone, [*keys, "_alone"], ["offset"]).drop("_alone")
    return kept if keep_tombstones else kept.filter(F.col("value").isNotNull() | F.col("key").isNull())


def compact_with_lag(df: DataFrame, min_lag_seconds: int, as_of: datetime | Column) -> DataFrame:
    """Compaction that keeps every record younger than the minimum lag.

    Old records survive only as the last of their key; a record without a time counts as old.  No
    window is needed: the young ones are a filter, the old survivors are the compacted
    records that are not young.
    """
    cutoff = _as_time(df, as_of) - F.make_dt_interval(secs=F.lit(float(min_lag_seconds)))
    is_young = F.coalesce(F.col("timestamp") > cutoff, F.lit(False))
    young = df.filter(is_young)
    old_survivors = compact(df).filter(~is_young)
    return old_survivors.unionByName(young)


def retain(
    df: DataFrame, retention_seconds: int, as_of: datetime | Column, time_col: str = "timestamp"
) -> DataFrame:
    """Records not older than the retention time."""
    cutoff = _as_time(df, as_of, time_col) - F.make_dt_interval(secs=F.lit(float(retention_seconds)))
    return df.filter(F.col(time_col) >= cutoff)


def compact_delete(df: DataFrame, retention_seconds: int, as_of: datetime | Column) -> DataFrame:
    """Compaction plus retention: both remove records independently."""
    return retain(compact(df), retention_seconds, as_of)


def _as_time(df: DataFrame, as_of: datetime | Column, time_col: str = "timestamp") -> Column:
    return F.lit(as_of).cast(df.schema[time_col].dataType)


# -- change logs -----------------------------------------------------------------------------


def unwrap_changes(df: DataFrame, op: str = "op", before: str = "before", after: str = "after") -> DataFrame:
    """Change events as row images: the state before a delete, after anything else."""
    meta = [c for c in df.columns if c not in (before, after)]
    image = F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))
    return df.withColumn("_row", image).select(*meta, "_row.*")


def current_rows(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """Current table of a change log: the last change of each key, deleted rows left out."""
    return latest_by_key(changes, keys, order, reread=False).filter(F.col(op) != "d")


def history_intervals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Each version of a row with the time it was valid; the current one has no end."""
    out = with_next(df, keys, order, order[0], end, rows)
    return out.withColumn(start, F.col(order[0]))


def dedupe_polls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of rows read again by overlapping polls; copies are combined
    before the shuffle.  On a stream use ``streaming.runs.dedupe_stream``."""
    return df.dropDuplicates(list(keys))


def first_then(
    df: DataFrame, keys: Sequence[str], time_col: str, start: Column, end: Column
) -> DataFrame:
    """Cycle time per key: first row that meets ``start``, then the first later one that
    meets ``end``; ``cycle_seconds`` is null for keys that have not got there.

    Two combined aggregations and a join of one row per key; no key's rows are collected.
    """
    keys = list(keys)
    begun = df.filter(start).groupBy(*keys).agg(F.min(time_col).alias("started"))
    candidates = df.filter(end).select(*keys, time_col)
    done = (
        lookup_join(candidates, begun, keys, "inner")
        .filter(F.col(time_col) > F.col("started"))
        .groupBy(*keys)
        .agg(F.min(time_col).alias("finished"))
    )
    out = begun.join(done, keys, "left")
    took = F.unix_micros(F.col("finished").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
    return out.withColumn("cycle_seconds", F.floor(took / 1_000_000).cast("bigint"))
