"""Session settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC makes date-histogram keys independent of the cluster's zone; ANSI makes bad casts raise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Cuts groups inside the map tasks for every n in use; Spark's own threshold is 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass SETTINGS to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quern")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
