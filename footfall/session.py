"""Spark session settings that the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A generated method above 8000 bytecodes is never compiled by the JVM and runs interpreted for the whole job, so
# stages that would need one are run operator by operator instead.
# Adaptive execution sizes reduce partitions, turns joins into broadcasts once a side's real size is known
# and splits skewed join partitions. RocksDB holds the keyed state of the streaming jobs outside the heap.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "footfall", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` entries override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
