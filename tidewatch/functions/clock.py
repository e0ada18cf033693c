"""Timestamp arithmetic on whole hours and microseconds.

Zone-less timestamps are never cast through a zoned one, so results do not depend on the session zone. Zoned timestamps
are read as the wall clock of the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
YEAR_SECONDS = 31557600  # 365.25 days


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(x: Column, n: int) -> Column:
    """Integer division rounding down, also for times before 1970."""
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def wall(ts: Column | str) -> Column:
    return col(ts).cast("timestamp_ntz")


def _second(x: Column) -> Column:
    return F.extract(F.lit("SECOND"), x)  # with its fraction, decimal(8,6)


def micros(ts: Column | str) -> Column:
    """Microseconds from 1970-01-01 00:00 to ts."""
    x = wall(ts)
    minutes = hour_floor(ts) * F.lit(60) + F.minute(x)
    return minutes * F.lit(60_000_000) + (_second(x) * F.lit(1_000_000)).cast("long")


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def hour_floor(ts: Column | str) -> Column:
    """Number of the hour that contains ts."""
    x = wall(ts)
    return F.unix_date(x.cast("date")).cast("long") * F.lit(24) + F.hour(x)


def hour_ceil(ts: Column | str) -> Column:
    """Number of the first full hour at or after ts: the first grid point that may see the event."""
    x = wall(ts)
    return hour_floor(ts) + F.when((F.minute(x) > 0) | (_second(x) > 0), F.lit(1)).otherwise(F.lit(0))


def from_hour(hour: Column | str) -> Column:
    return from_micros(col(hour) * F.lit(HOUR_US))


def trunc_hour(ts: Column | str) -> Column:
    """date_trunc('hour') that stays zone-less."""
    return from_hour(hour_floor(ts))


def epoch_seconds(ts: Column | str) -> Column:
    return micros(ts) / F.lit(1e6)


def hours_since(t: Column | str, anchor: Column | str) -> Column:
    """Elapsed hours, NULL when either side is NULL; negative before the anchor."""
    return (micros(t) - micros(anchor)) / F.lit(float(HOUR_US))


def shift(ts: Column | str, hours: int) -> Column:
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


def between_offsets(ts: Column | str, lo: Column | str, hi: Column | str, before: int = 0, after: int = 0) -> Column:
    """ts in [lo - before hours, hi + after hours], both ends included."""
    return col(ts).between(shift(lo, -before), shift(hi, after))


def default_end(start: Column | str, end: Column | str, hours: int = 1) -> Column:
    """End of an interval; an open or point interval lasts `hours`."""
    return F.coalesce(col(end), shift(start, hours))


def capped_age(dob: Column | str, at: Column | str, cap_years: int = 89, cap_value: float = 90.0) -> Column:
    """Age in years of 365.25 days; calendar ages of cap_years and above read cap_value."""
    capped = col(at) >= col(dob) + F.make_ym_interval(F.lit(cap_years))
    years = (micros(at) - micros(dob)) / F.lit(1e6) / F.lit(float(YEAR_SECONDS))
    return F.when(capped, F.lit(float(cap_value))).otherwise(years)


def round_half_up(x: Column | str) -> Column:
    return F.floor(col(x) + F.lit(0.5)).cast("int")
