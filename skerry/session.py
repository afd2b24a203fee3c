"""Session construction and the runtime settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. UTC makes date arithmetic
# comparable across engines; the skew settings let a join split a hot key.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "skerry", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session; `conf` keys use `__` in place of dots.

    Adaptive execution merges shuffle partitions but adds none, so set
    `spark.sql.shuffle.partitions` to what the largest shuffle of the job needs.
    Queries and operators change no setting of the session they are given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return settle(builder.getOrCreate())
