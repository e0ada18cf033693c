"""Entity selection, context joins and event restriction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.clock import between_offsets, col, default_end, shift


def first_per(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str]) -> DataFrame:
    """First row per key. The rank filter becomes a group limit that already runs before the shuffle, so a hot key
    reaches its task as one row per input partition."""
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def latest_per(df: DataFrame, key: Sequence[str], ts: str, tiebreak: str) -> DataFrame:
    """Latest row per key, ties on time decided by the larger tiebreak."""
    return first_per(df, key, [F.col(ts).desc(), F.col(tiebreak).desc()])


def attach_context(stays: DataFrame, admissions: DataFrame, subjects: DataFrame, admission_key: str = "hadm_id",
                   subject_key: str = "subject_id") -> DataFrame:
    return stays.join(admissions, admission_key).join(subjects, subject_key)


def attach_optional(df: DataFrame, attributes: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Left equi-join; rows without a match keep NULL."""
    return df.join(attributes, keys, "left")


def add_from(df: DataFrame, other: DataFrame, key: str, **columns: Column) -> DataFrame:
    """Add columns computed from a table with one row per key; unmatched rows get NULL."""
    return df.join(other.select(key, *[c.alias(name) for name, c in columns.items()]), key, "left")


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def in_list(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def range_by_group(df: DataFrame, key: Sequence[str], ts: str, lo: str = "t_min", hi: str = "t_max") -> DataFrame:
    return df.groupBy(*key).agg(F.min(ts).alias(lo), F.max(ts).alias(hi))


def min_by_group(df: DataFrame, key: Sequence[str], ts: str, name: str) -> DataFrame:
    return df.groupBy(*key).agg(F.min(ts).alias(name))


def restrict_events(events: DataFrame, bounds: DataFrame, key: str, ts: str, lo: str, hi: str, before: int = 0,
                    after: int = 0, ids: DataFrame | None = None, item: str = "itemid") -> DataFrame:
    """Events of the bounded entities within [lo - before, hi + after] hours, optionally of listed items.

    Both joins are plain equi-joins. Spark broadcasts the item list or the bounds when their size allows, and splits
    a hot entity through its skew join when it does not.
    """
    kept = events if ids is None else events.join(ids, item)
    return kept.join(bounds, key).filter(between_offsets(ts, lo, hi, before, after))


def restrict_intervals(intervals: DataFrame, bounds: DataFrame, key: str, start: str, end: str, lo: str, hi: str,
                       before: int = 0, open_hours: int = 1) -> DataFrame:
    """Intervals that overlap [lo - before, hi], closed; an open end counts as start + open_hours."""
    filled = intervals.withColumn(end, default_end(start, end, open_hours))
    return filled.join(bounds, key).filter((col(start) <= col(hi)) & (col(end) >= shift(lo, -before)))
