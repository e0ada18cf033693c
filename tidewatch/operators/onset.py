"""First qualifying hour per entity and the forward-looking label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.bands import horizon_label
from tidewatch.functions.clock import between_offsets


def min_where(ts: str, condition: Column) -> Column:
    return F.min(F.when(condition, F.col(ts)))


def first_time_where(df: DataFrame, keys: Sequence[str], t: str, condition: Column, anchors: DataFrame,
                     anchor_key: str, anchor: str, before: int, after: int, name: str = "t_onset") -> DataFrame:
    """Per entity the first t that meets the condition within [anchor - before, anchor + after] hours.

    `anchors` has at most one row per anchor_key. Every entity keeps a row, with NULL when nothing qualifies.
    """
    near = between_offsets(t, anchor, anchor, before, after)
    return (
        df.join(anchors.select(anchor_key, anchor), anchor_key, "left")
        .groupBy(*keys)
        .agg(min_where(t, condition & near).alias(name))
    )


def label_hours(grid: DataFrame, onset: DataFrame, keys: Sequence[str], t: str, hours: int, onset_ts: str = "t_onset",
                name: str = "label6h") -> DataFrame:
    """Grid rows with the horizon label; rows at or after the onset have a NULL label."""
    return grid.join(onset, list(keys), "left").withColumn(name, horizon_label(t, onset_ts, hours))


def clean_labels(labelled: DataFrame, name: str = "label6h", view: str | None = None) -> DataFrame:
    """Labelled rows only, optionally published under a view name."""
    out = labelled.filter(F.col(name).isNotNull())
    if view:
        out.createOrReplaceTempView(view)
    return out
