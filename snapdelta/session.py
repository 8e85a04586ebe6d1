"""Session settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times are UTC; the rest lets Spark size partitions, split skewed ones and pick joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Does without the Python call site of every column, which only serves error messages.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the settings. On a cluster choose ``shuffle_partitions`` so that a partition of the largest shuffle
    fits an executor core (about 200 MB); adaptive execution merges what turns out small."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)) if shuffle_partitions else builder
