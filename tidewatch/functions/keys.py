"""Stable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.clock import col


def row_id(ids: Sequence[Column | str], t: Column | str) -> Column:
    """md5 over integer ids and the time, joined by a pipe. Ids must be integers: float ids print differently."""
    parts = [col(c).cast("long").cast("string") for c in ids]
    return F.md5(F.concat_ws("|", *parts, F.date_format(col(t), "yyyy-MM-dd HH:mm:ss")))


def parse_ts_or_null(c: Column | str) -> Column:
    """Timestamp of a text, NULL where it does not parse."""
    return F.try_to_timestamp(col(c)).cast("timestamp_ntz")
