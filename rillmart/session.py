"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. They fix meaning (time
# zone) or let Spark re-plan at run time; none of them sets a cluster size.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split an oversized join partition even when that costs a later shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie shuffled by some of a join's columns are not shuffled again by all of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Rows for up to so many folders are written as they come; only for more are they sorted, and spilled, by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def prepare(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Fix the warehouse time zone and the adaptive settings on ``spark``.

    Every day and window label is computed in ``zone``; the shop of the
    original feeds lives in ``Asia/Shanghai``.
    """
    spark.conf.set("spark.sql.session.timeZone", zone)
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "rillmart", master: str | None = None, zone: str = "UTC",
          **conf: str) -> SparkSession:
    """Session for batch and streaming jobs, with the RocksDB state store."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # No call site per column expression; wide jobs are made of hundreds of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate(), zone)
