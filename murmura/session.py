"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("murmura")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """Show times in UTC. The jobs read and cut them in UTC whatever the session's zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
