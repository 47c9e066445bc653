"""What happens to a record that an operator cannot process."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "_error"
POLICIES = ("reject", "drop", "fail")


def first_error(*errors: Column | None) -> Column:
    """The first non-null message of several, or null."""
    found = [e for e in errors if e is not None]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def with_errors(df: DataFrame, error: Column, on_error: str = "reject", costly: bool = False) -> DataFrame:
    """Attach ``error`` as ``_error`` and apply a policy.

    ``reject`` keeps every row with its message, ``drop`` removes failed rows,
    ``fail`` stops the job at the first failed row.

    ``costly`` is for messages that take parsing to find out: the optimizer would copy
    the parsing into a filter below, once per mention.  A non-deterministic column next to
    the message keeps the filter where it is; filters on other columns then have to be
    stated before the operator.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}, not {on_error!r}")
    if ERROR in df.columns:  # an earlier operator's message wins
        error = F.coalesce(F.col(ERROR), error)
    tagged = df.withColumn(ERROR, error)
    if on_error == "reject":
        return tagged
    here = F.lit(True)
    if costly:
        tagged = tagged.withColumn("_task", F.spark_partition_id())
        here = F.col("_task") >= 0
    if on_error == "drop":
        return tagged.filter(F.col(ERROR).isNull() & here).drop(ERROR, "_task")
    stop = F.when(F.col(ERROR).isNotNull(), F.raise_error(F.col(ERROR)).cast("boolean")).otherwise(True)
    return tagged.filter(stop & here).drop(ERROR, "_task")


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays where it is, above what it took to compute its columns."""
    return df.withColumn("_task", F.spark_partition_id()).filter(condition & (F.col("_task") >= 0)).drop("_task")


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the message, rejected rows with it)."""
    return df.filter(F.col(ERROR).isNull()).drop(ERROR), df.filter(F.col(ERROR).isNotNull())


def error_counts(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Row and error counts, optionally per group."""
    failed = F.count(F.col(ERROR)).alias("n_failed")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), failed)


def any_of(conditions: list[Column]) -> Column:
    """OR of a list; false when it is empty."""
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)
