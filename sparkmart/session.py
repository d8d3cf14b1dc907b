"""Session defaults the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings; each can be overridden per job.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",  # a bad cast stops the run
    "spark.sql.session.timeZone": "UTC",  # calendar days are UTC days
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",  # dynamic only where a loader asks
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM never compiles a method over 8000 bytes. Wide staging projections
    # would end up in one and run interpreted; past the limit Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the defaults on a session made elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "sparkmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session. ``conf`` keys use ``__`` for dots.

    On a cluster set ``spark.sql.shuffle.partitions`` to a small multiple of the
    executor cores: adaptive execution merges small partitions, it does not
    split healthy ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
