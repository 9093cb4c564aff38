"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone: unix seconds become the same timestamp on every cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("palate")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.retainedStages", "100000")  # figures of stages are read; Spark forgets all but 1,000
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
