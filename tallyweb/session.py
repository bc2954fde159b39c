"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Semantics, not tuning: time zone of buckets, and the newer value wins when maps are merged.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.mapKeyDedupPolicy": "LAST_WIN"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyweb")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
