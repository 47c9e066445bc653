"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime SQL settings; all of them may be changed on a live session.
RUNTIME_CONF = {
    # events carry wall-clock UTC times
    "spark.sql.session.timeZone": "UTC",
    # run-time re-planning: coalesced shuffles, broadcast by measured size, split skewed joins
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a JSON object may repeat a key: the last one wins
    "spark.sql.variant.allowDuplicateKeys": "true",
    # merge session windows before the shuffle, so that a hot key sends few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemill")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
