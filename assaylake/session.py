"""Session settings the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A sort-merge join becomes a hash join where every shuffled partition turns out small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Splitting a hot partition is worth a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int | str = "*", memory: str = "8g", name: str = "assaylake") -> SparkSession:
    """A single-machine session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    count = os.cpu_count() if cores == "*" else cores
    return (
        builder.config("spark.sql.shuffle.partitions", str(count))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
