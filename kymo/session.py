"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def pin_session(spark: SparkSession) -> SparkSession:
    """Recording clocks are zone-less, so the session reads them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "*", name: str = "kymo", partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
