"""Counting, lag and reconciliation of a source with its replica."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.skew import lookup_join

# --- fixed values -----------------------------------------------------------------------
#: a replica with at least this share of the source's messages is "close"
CLOSE_PERCENT = 95
#: topics whose clean-up policy is compared: the name contains one of these
POLICY_NAMES = ("state", "events")
# ----------------------------------------------------------------------------------------


def end_offsets(records: DataFrame) -> DataFrame:
    """High watermark (last offset + 1) of each topic partition."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def message_counts(records: DataFrame) -> DataFrame:
    """Messages per topic: the sum of its partitions' high watermarks."""
    return end_offsets(records).groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def partition_counts(records: DataFrame) -> DataFrame:
    """Number of partitions per topic."""
    return records.select("topic", "partition").distinct().groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions")
    )


def _sides(source: DataFrame, target: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    return source.withColumnRenamed(value, "source").join(
        target.withColumnRenamed(value, "target"), list(on), "full"
    )


def lag_by_topic(source: DataFrame, target: DataFrame) -> DataFrame:
    """How far the target's partitions are behind, summed per topic.

    Only one row per topic partition is joined."""
    both = _sides(end_offsets(source), end_offsets(target), ["topic", "partition"], "end_offset")
    behind = F.greatest(
        F.coalesce("source", F.lit(0).cast("bigint")) - F.coalesce("target", F.lit(0).cast("bigint")),
        F.lit(0).cast("bigint"),
    )
    return both.groupBy("topic").agg(F.sum(behind).alias("lag"))


def reconcile_topics(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per topic: where it exists, its message and partition counts, and a verdict.

    ``equal``, ``close`` (at least 95 % of the source, in integers), ``mismatch``, or the
    side that alone has the topic.
    """
    def stats(records: DataFrame) -> DataFrame:
        return end_offsets(records).groupBy("topic").agg(
            F.sum("end_offset").alias("messages"), F.count(F.lit(1)).alias("partitions")
        )

    s, t = stats(source).alias("s"), stats(target).alias("t")
    both = s.join(t, F.col("s.topic") == F.col("t.topic"), "full")
    floor = F.call_function("div", F.col("s.messages") * CLOSE_PERCENT, F.lit(100).cast("bigint"))
    verdict = (
        F.when(F.col("t.topic").isNull(), "source only")
        .when(F.col("s.topic").isNull(), "target only")
        .when(F.col("s.messages") == F.col("t.messages"), "equal")
        .when(F.col("t.messages") >= floor, "close")
        .otherwise("mismatch")
    )
    return both.select(
        F.coalesce("s.topic", "t.topic").alias("topic"),
        F.col("s.messages").alias("source_messages"),
        F.col("t.messages").alias("target_messages"),
        F.col("s.partitions").alias("source_partitions"),
        F.col("t.partitions").alias("target_partitions"),
        F.coalesce(F.col("s.partitions") == F.col("t.partitions"), F.lit(False)).alias("partitions_match"),
        verdict.alias("verdict"),
    )


def config_matches(source: DataFrame, target: DataFrame, name: str = "cleanup.policy") -> DataFrame:
    """Compare one setting for the topics whose name asks for it; tables are
    ``(topic, name, value)``."""
    wanted = F.lit(False)
    for part in POLICY_NAMES:
        wanted = wanted | F.col("topic").contains(part)

    def side(df: DataFrame) -> DataFrame:
        return df.filter((F.col("name") == name) & wanted).select("topic", "value")

    both = _sides(side(source), side(target), ["topic"], "value")
    return both.withColumn("matches", F.coalesce(F.col("source") == F.col("target"), F.lit(False)))


def migration_summary(source: DataFrame, target: DataFrame, target_subjects: DataFrame) -> DataFrame:
    """One row: topics of the source, how many the target has, its schema count, and
    whether the migration is complete."""
    found = target.select("topic").distinct().withColumn("found", F.lit(1))
    topics = source.select("topic").distinct().join(found, "topic", "left").drop("topic")
    subjects = target_subjects.select("subject").distinct()
    rows = topics.withColumn("wanted", F.lit(1)).unionByName(subjects, allowMissingColumns=True)
    counts = rows.agg(
        F.count("wanted").alias("total"), F.count("found").alias("migrated"), F.count("subject").alias("schemas")
    )
    return counts.withColumn("complete", (F.col("migrated") == F.col("total")) & (F.col("schemas") > 0))


# -- sets of names ---------------------------------------------------------------------------


def only_in(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct names of ``a`` that ``b`` lacks."""
    return a.select(*cols).distinct().join(b.select(*cols).distinct(), list(cols), "left_anti")


def in_both(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct names on both sides."""
    return a.select(*cols).distinct().join(b.select(*cols).distinct(), list(cols), "left_semi")


def sets_equal(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the sizes of both differences and whether the sets are equal."""
    marked = (
        a.select(*cols).distinct().withColumn("_a", F.lit(1))
        .join(b.select(*cols).distinct().withColumn("_b", F.lit(1)), list(cols), "full")
    )
    counts = marked.agg(
        F.count(F.when(F.col("_b").isNull(), 1)).alias("only_first"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("only_second"),
    )
    return counts.withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def merge_topics(*topics: DataFrame) -> DataFrame:
    """Several topics as one sequence of records."""
    out = topics[0]
    for t in topics[1:]:
        out = out.unionByName(t)
    return out


def fail_over(source: DataFrame, target: DataFrame, cut: DataFrame) -> DataFrame:
    """Records as a consumer sees them that moved to the replica at ``cut`` = (topic,
    partition, offset): the source's before the cut, the target's from it on.

    Partitions without a cut stay with the source.  The cut has one row per partition.
    """
    at = cut.select("topic", "partition", F.col("offset").alias("_cut"))
    before = lookup_join(source, at, ["topic", "partition"]).filter(
        F.col("_cut").isNull() | (F.col("offset") < F.col("_cut"))
    )
    after = lookup_join(target, at, ["topic", "partition"], "inner").filter(F.col("offset") >= F.col("_cut"))
    return before.drop("_cut").select(source.columns).unionByName(after.drop("_cut").select(source.columns))
