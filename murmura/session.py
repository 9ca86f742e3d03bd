"""Session defaults. On a cluster the submitter's settings win; these only fill gaps in local runs."""
from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A local session with UTC time, adaptive execution and few shuffle partitions; more: settings with _ for dots."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("murmura")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config(map={k.replace("_", "."): v for k, v in more.items()})
        .getOrCreate()
    )
