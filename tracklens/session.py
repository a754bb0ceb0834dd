"""SparkSession construction shared by tests, the bench and scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "tracklens", cpus: str | int = "*", shuffle_partitions: int = 8, driver_memory: str = "6g", **extra: str) -> SparkSession:
    """A local session with the settings every query assumes (UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
