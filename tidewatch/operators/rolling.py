"""Lags, differences and rolling statistics over the hourly rows of an entity.

All functions take a finished window, so that any number of them shares one exchange and one sort. A window partition
holds the grid hours of one entity, a number bounded by the calendar and not by the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def grid_window(keys: Sequence[str], t: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(t)


def lags(w: WindowSpec, columns: dict[str, str], steps: Sequence[int] = (1, 2)) -> list[Column]:
    """`<prefix>_lag<k>` for every prefix -> column."""
    return [F.lag(c, k).over(w).alias(f"{p}_lag{k}") for p, c in columns.items() for k in steps]


def diffs(columns: dict[str, str]) -> list[Column]:
    """`_diff1` = x - lag1, `_diff2` = lag1 - lag2."""
    out = []
    for p, c in columns.items():
        out += [F.expr(f"{c} - {p}_lag1 AS {p}_diff1"), F.expr(f"{p}_lag1 - {p}_lag2 AS {p}_diff2")]
    return out


ROLLERS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling(w: WindowSpec, prefix: str, column: str, stats: Sequence[str], rows: int) -> list[Column]:
    """`<prefix>_<stat>_<rows>h` over the current and the rows - 1 preceding rows. std is NULL for one value."""
    frame = w.rowsBetween(1 - rows, Window.currentRow)
    return [ROLLERS[s](F.col(column)).over(frame).alias(f"{prefix}_{s}_{rows}h") for s in stats]


def rolling_slope(w: WindowSpec, prefix: str, column: str, seconds: str, rows: int = 6) -> Column:
    """Least-squares slope per second; NULL values are skipped, NULL below two points. `seconds` is a column, as a time inside the
    window function would be taken apart for every row of every frame."""
    frame = w.rowsBetween(1 - rows, Window.currentRow)
    return F.regr_slope(F.col(column), F.col(seconds)).over(frame).alias(f"{prefix}_slope_{rows}h")


def all_missing_flag(w: WindowSpec, prefix: str, column: str, rows: int = 6) -> Column:
    frame = w.rowsBetween(1 - rows, Window.currentRow)
    return F.when(F.count(F.col(column)).over(frame) == 0, 1).otherwise(0).alias(f"{prefix}_miss_{rows}h")
