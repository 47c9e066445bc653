"""Flow metrics over work items: lead time, throughput, aging, service levels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.keyed import latest_by_key


def _seconds(start: Column, end: Column) -> Column:
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def lead_time(df: DataFrame, created: str, resolved: str, by: Sequence[str] = ()) -> DataFrame:
    """Resolved items and their average seconds from creation to resolution."""
    took = _seconds(F.col(created), F.col(resolved))
    return df.groupBy(*by).agg(F.count(took).alias("resolved"), F.avg(took).alias("avg_lead_seconds"))


def throughput(df: DataFrame, time_col: str, period: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """Items per period."""
    return df.groupBy(F.date_trunc(period, time_col).alias("period"), *by).agg(F.count(F.lit(1)).alias("n"))


def aging(
    df: DataFrame, created: str, width_days: int, as_of: datetime | Column, by: Sequence[str] = ()
) -> DataFrame:
    """Histogram of ages: items, and youngest, oldest, median and 90th-percentile age in days per bucket.

    Percentiles are exact: what is combined is a count for each of a bucket's ages, at most ``width_days``.
    """
    days = F.datediff(F.lit(as_of).cast("date"), F.col(created).cast("date"))
    aged = df.withColumn("_age", days)
    bucket = F.floor(F.col("_age") / width_days).cast("bigint")
    return aged.groupBy(bucket.alias("bucket"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_age").cast("bigint").alias("min_age"),
        F.max("_age").cast("bigint").alias("max_age"),
        F.percentile("_age", 0.5).alias("median_age"),
        F.percentile("_age", 0.9).alias("p90_age"),
    )


def sla_compliance(
    df: DataFrame, created: str, resolved: str, target_seconds: int, by: Sequence[str] = ()
) -> DataFrame:
    """Share of resolved items, in percent, that were resolved within the target."""
    took = _seconds(F.col(created), F.col(resolved))
    met = F.count(F.when(took <= target_seconds, 1))
    return df.groupBy(*by).agg(
        F.count(took).alias("resolved"),
        met.alias("within_target"),
        (met * 100.0 / F.nullif(F.count(took), F.lit(0))).alias("percent"),
    )


def contributions(df: DataFrame, who: str, time_col: str, period: str = "week") -> DataFrame:
    """Items per contributor and period."""
    return throughput(df, time_col, period, [who])


def stale_items(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    days: int,
    as_of: datetime | Column,
    important: Column,
) -> DataFrame:
    """Items whose latest state is important and older than ``days``; order[0] is the update time."""
    updated = order[0]
    cutoff = F.lit(as_of).cast(df.schema[updated].dataType) - F.make_dt_interval(days=F.lit(days))
    return latest_by_key(df, keys, order).filter(important & (F.col(updated) < cutoff))
