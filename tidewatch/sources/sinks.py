"""Writers for tables, splits, predictions and run summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CSV = {"header": True, "nullValue": "NULL", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}
PREDICTION_KEYS = ("subject_id", "hadm_id", "icustay_id", "t", "label6h", "row_id")


def persist(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at path and return a scan of it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def persist_measured(df: DataFrame, path: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """Write the table and return a scan of it with aggregates of its rows.

    They are read from the written columns that they name. Spark could observe them while it writes, but a session that has done so can
    no longer apply fitted vector models: its observation manager is caught in their closures and cannot be sent to tasks.
    """
    written = persist(df, path)
    return written, written.agg(*[c.alias(name) for name, c in aggregates.items()]).first().asDict()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def export_split(df: DataFrame, directory: str, split: str = "split") -> None:
    """One CSV folder per split value, all written in one pass; rows without a split stay out."""
    keyed = df.filter(F.col(split).isNotNull()).withColumn("_part", F.col(split))
    keyed.write.mode("overwrite").options(**CSV).partitionBy("_part").csv(directory)


def split_path(directory: str, value: str) -> str:
    return f"{directory}/_part={value}"


def write_predictions(df: DataFrame, path: str, probability: str, extra: Sequence[str] = ()) -> None:
    """Keys, label, row key and probability; rows without a prediction stay out."""
    columns = [c for c in (*PREDICTION_KEYS, *extra) if c in df.columns]
    write_csv(df.filter(F.col(probability).isNotNull()).select(*columns, probability), path)


def write_summary(spark: SparkSession, path: str, values: Mapping[str, object]) -> None:
    """One JSON record."""
    spark.createDataFrame([dict(values)]).coalesce(1).write.mode("overwrite").json(path)
