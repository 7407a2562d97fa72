"""Session settings the builders assume.

Builders never change session settings themselves; a job creates its session
here (or sets the same values in its own submit configuration).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "tallyhouse", cpus: str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
