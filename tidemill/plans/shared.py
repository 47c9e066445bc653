"""The shared folder for checkpoints and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemill-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint: what later jobs read never changes,
    also when an executor is lost in between."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, what an action has shuffled leaves the disks as soon as it ends, not when the driver's memory is
    next tidied up.  Meant for tables that are materialized once; one built here and used again is shuffled again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
