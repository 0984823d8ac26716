"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast sides from measured shuffle sizes and
# splits skewed join partitions; forcing the split keeps a hot key from landing
# in one task even where that costs one more exchange downstream. The factor
# makes the static estimate of a compressed Parquet scan honest, so that a side
# is not broadcast for its small file.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "terrace") -> SparkSession:
    """A session for tests and the bench; a cluster passes its own session in."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TERRACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
