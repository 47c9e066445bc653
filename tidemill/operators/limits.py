"""Limits, newest-first reports and ordered output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.records import decode_cols
from tidemill.plans.ordered import slice_count, top_per_key

def run_sql(
    spark: SparkSession, text: str, limit: int | None = None, decode: Sequence[str] = (), **frames: DataFrame
) -> DataFrame:
    """A SQL text as a frame, with binary columns decoded and, if asked for, a row limit.
    ``frames`` are the tables that the text names in braces; nothing is registered in the session.
    Keep the result in a variable to go on with it."""
    df = decode_cols(spark.sql(text, **frames), decode)
    return df if limit is None else df.limit(limit)


def list_row(df: DataFrame) -> DataFrame:
    """One row as a ``(column, value)`` listing, in column order."""
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for i, c in enumerate(df.columns)
        ]
    )
    return df.limit(1).select(F.inline(pairs))


def newest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows; each task keeps ``n``, nothing is sorted as a whole."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def first_of_topic(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of every topic partition."""
    return top_per_key(records, ["topic", "partition"], ["offset"], n, "_n").drop("_n")


def last_of_topic(records: DataFrame) -> DataFrame:
    """The last record of every topic partition."""
    rest = [c for c in records.columns if c not in ("topic", "partition")]
    return (
        records.groupBy("topic", "partition")
        .agg(F.max_by(F.struct(*rest), "offset").alias("_r"))
        .select("topic", "partition", "_r.*")
        .select(*records.columns)
    )


def reversed_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in reverse order; a distributed sort by range."""
    return df.orderBy(*[F.col(c).desc() for c in order])


def offset_order(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Records so laid out that every task holds a run of offsets in order.

    The ranges run over topic, partition and offset: a partition with many records is cut
    into several consecutive runs instead of filling one task.
    """
    cols = ["topic", "partition", "offset"]
    n = partitions or slice_count(records)
    return records.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
