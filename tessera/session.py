"""Session defaults: UTC, adaptive execution with skew joins, maps that keep the last value of a key."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(name: str = "tessera", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (DEFAULTS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
