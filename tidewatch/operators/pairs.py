"""Pairs of events that lie within a time range of each other, reduced to the earliest per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.clock import HOUR_US, floor_div, from_micros, micros


def _followed(left: DataFrame, right: DataFrame, key: str, within: int) -> DataFrame:
    """Left rows (key, us) that have a right row in [us, us + within].

    Time is cut into buckets as wide as `within`. A partner can then only sit in the same bucket, where the largest
    right time decides, or in the next one, where the smallest does. Both come from one small aggregate, so each left
    row meets at most one joined row and no pairs are emitted.
    """
    cells = (
        right.groupBy(key, floor_div(F.col("us"), within).alias("_b"))
        .agg(F.max("us").alias("_hi"), F.min("us").alias("_lo"))
        .select(key, F.inline(F.array(
            F.struct(F.col("_b").alias("_b"), F.col("_hi").alias("_here"), F.lit(None).cast("long").alias("_next")),
            F.struct((F.col("_b") - 1).alias("_b"), F.lit(None).cast("long").alias("_here"), F.col("_lo").alias("_next")),
        )))
        .groupBy(key, "_b").agg(F.max("_here").alias("_here"), F.min("_next").alias("_next"))
    )
    bucketed = left.withColumn("_b", floor_div(F.col("us"), within))
    hit = (F.col("us") <= F.col("_here")) | (F.col("_next") <= F.col("us") + F.lit(within))
    return bucketed.join(cells, [key, "_b"]).filter(hit).select(key, "us")


def pair_within(a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str, after: int, before: int,
                name: str = "t_pair") -> DataFrame:
    """Earliest min(a, b) per key over pairs with b in [a, a + after] or a in [b, b + before] (hours, inclusive)."""
    left = a.select(key, micros(a_ts).alias("us")).dropna()
    right = b.select(key, micros(b_ts).alias("us")).dropna()
    starts = _followed(left, right, key, after * HOUR_US).unionByName(_followed(right, left, key, before * HOUR_US))
    return starts.groupBy(key).agg(F.min("us").alias("_us")).select(key, from_micros(F.col("_us")).alias(name))
