"""A session with the settings this engine is tested under. Any Spark 4 session works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
