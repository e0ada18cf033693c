"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins stay adaptive: broadcast sides are chosen by measured size, skewed joins are split.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide projections outgrow the size up to which HotSpot compiles a method; fall back instead of interpreting them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewatch")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
