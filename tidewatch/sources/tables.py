"""Base-table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
         "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Lazy scan of one table; filters and column choice reach the Parquet reader."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
