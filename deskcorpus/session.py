"""Session for tests and benchmarks on one machine. Cluster jobs bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "deskcorpus", memory: str = "8g") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
