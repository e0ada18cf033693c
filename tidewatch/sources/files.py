"""File readers with the checks the input contracts ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_SCHEMA = T.StructType([T.StructField("itemid", T.IntegerType())])
NOTE_COLUMNS = ("subject_id", "hadm_id", "icustay_id", "t", "notes_24h", "label6h")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Table with a header; the word NULL is missing, times are zone-less.

    `multi_line` lets quoted fields span lines; Spark then reads each file in one task, so large exports should be many
    files.
    """
    options = {"header": True, "nullValue": "NULL", "multiLine": multi_line, "escape": '"', "mode": "FAILFAST",
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}
    return spark.read.options(**options).schema(schema).csv(path)


def read_notes(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Notes table: all contract columns present, missing text is empty."""
    df = read_csv(spark, path, schema, multi_line=True)
    missing = set(NOTE_COLUMNS) - set(df.columns)
    if missing:
        raise ValueError(f"notes lack {sorted(missing)}")
    return df.fillna("", subset=["notes_24h"])


def load_idlist(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(itemid, kind) from a one-column file. Missing or repeated ids are an error, as for a primary key."""
    ids = spark.read.csv(path, schema=ID_SCHEMA, header=True, mode="FAILFAST")
    bad = ids.groupBy("itemid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR itemid IS NULL")
    if not bad.isEmpty():
        raise ValueError(f"id list {path} has missing or repeated ids")
    return ids.withColumn("kind", F.lit(kind))
