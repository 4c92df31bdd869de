"""Spark session for local use; a cluster brings its own settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "rrnlake", cores: str | int = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators are tuned for."""
    parallel = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
