"""Session defaults for local runs; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("chronoloom")
    for key, value in (DEFAULTS | extra).items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
