"""Signals on an hourly grid: bounded as-of values, trailing sums, existence marks and interval marks.

Grid points lie on full hours and every lookback is a whole number of hours, so "t - w < ts <= t" depends only on the
first full hour at or after ts. Events therefore collapse to one cell per entity and hour before anything is ordered:

    events + interval edges -> group by (entity, hour) -> cells
    cells + grid            -> window per entity

The grouping runs map-side first and then spreads by (entity, hour), so an entity with a third of all events reaches the
window as at most one cell per calendar hour (8 784 a year), whatever its event count. All signals of all sources share
these two exchanges, and grid rows pass only the second.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewatch.functions.clock import HOUR_US, floor_div, from_hour, hour_ceil, hour_floor, micros


@dataclass(frozen=True)
class Latest:
    """Value of the newest event in (t - hours, t]. Ties on time go to the larger `tiebreak`."""

    name: str
    source: str
    kind: str | None = None
    hours: int = 24


@dataclass(frozen=True)
class Total:
    """Sum of values over (t - hours, t], NULL when there is none.

    Decimal values are summed as decimals of their own scale, all others as doubles. The result is a double.
    """

    name: str
    source: str
    hours: int
    kind: str | None = None


@dataclass(frozen=True)
class Seen:
    """True when an event lies in (t - hours, t]; needs no value. Several sources count as one."""

    name: str
    sources: tuple[str, ...]
    kind: str | None = None
    hours: int = 24


@dataclass(frozen=True)
class Covered:
    """True when some interval has start <= t < end. Several sources count as one."""

    name: str
    sources: tuple[str, ...]


Signal = Latest | Total | Seen | Covered


@dataclass(frozen=True)
class Events:
    """An event table: entity keys, ts, value, optionally kind and an integer tiebreak."""

    df: DataFrame
    ts: str = "charttime"
    value: str | None = "value"
    kind: str | None = None
    tiebreak: str | None = None


@dataclass(frozen=True)
class Intervals:
    df: DataFrame
    start: str = "starttime"
    end: str = "endtime"


def hourly_grid(df: DataFrame, start: str, end: str, t: str = "t") -> DataFrame:
    """One row per full hour from the hour of start to the hour of end; no rows for missing or reversed bounds."""
    lo, hi = hour_floor(start), hour_floor(end)
    hours = F.when(hi >= lo, F.sequence(lo, hi))
    return df.withColumn("_hour", F.explode(hours)).withColumn(t, from_hour("_hour")).drop("_hour")


def _sources_of(signal: Signal) -> tuple[str, ...]:
    return signal.sources if isinstance(signal, (Seen, Covered)) else (signal.source,)


def hourly_state(grid: DataFrame, keys: Sequence[str], sources: dict[str, Events | Intervals],
                 signals: Sequence[Signal], t: str = "t") -> DataFrame:
    """(keys, t) of the grid with one column per signal.

    The result is partitioned by the keys and sorted by (keys, `_h`): lags and rolling windows over (keys, `_h`) and
    equi-joins on the keys add no exchange. `_h` is 2 * hour for a cell and 2 * hour + 1 for a grid row, which puts the
    cell of an hour in front of the grid row that may see it.
    """
    keys = list(keys)
    codes: dict[tuple[str, str | None], int] = {}
    for s in signals:
        for source in _sources_of(s):
            codes.setdefault((source, getattr(s, "kind", None)), len(codes))

    full = F.when(F.col(t).isNull() | (from_hour(hour_floor(t)) == F.col(t)), hour_floor(t)).otherwise(
        F.raise_error(F.lit(f"grid times in {t} must be full hours")))
    points = grid.select(*keys, (full * 2 + 1).alias("_h"), F.lit(True).alias("_grid"))
    feeds = []
    for name, source in sources.items():
        wanted = [(kind, code) for (src, kind), code in codes.items() if src == name]
        if wanted:
            feed = _interval_edges if isinstance(source, Intervals) else _event_cells
            feeds.append(feed(source, keys, wanted))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)

    cells: dict[str, str] = {}
    window = f"PARTITION BY {', '.join(keys)} ORDER BY _h"
    so_far = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def cell(prefix: str, source: str, kind: str | None) -> str:
        code = codes[(source, kind)]
        here = f"_code = {code}"
        cells[f"{prefix}{code}"] = {
            "_last": f"max_by(_value, _ord) FILTER (WHERE {here} AND _value IS NOT NULL)",
            "_sum": f"sum({'_exact' if _is_decimal(sources[source]) else '_value'}) FILTER (WHERE {here})",
            "_seen": f"max(1) FILTER (WHERE {here})",
            "_edges": f"sum(_edge) FILTER (WHERE {here})",
        }[prefix]
        return f"{prefix}{code}"

    def fresh(c: str, hours: int) -> str:
        return f"last(if({c} IS NULL, NULL, _h), true) {so_far} > _h - {2 * hours + 1}"

    outputs = []
    for s in signals:
        if isinstance(s, Latest):
            c = cell("_last", s.source, s.kind)
            out = f"CASE WHEN {fresh(c, s.hours)} THEN last({c}, true) {so_far} END"
        elif isinstance(s, Total):
            # A bounded frame re-adds at most `hours` cells and grid rows each; nothing outside it, such as a NaN or a
            # huge amount, touches the sum.
            c = cell("_sum", s.source, s.kind)
            out = f"CAST(sum({c}) OVER ({window} RANGE BETWEEN {2 * s.hours - 1} PRECEDING AND CURRENT ROW) AS double)"
        elif isinstance(s, Seen):
            out = " OR ".join(f"coalesce({fresh(cell('_seen', x, s.kind), s.hours)}, false)" for x in s.sources)
        else:
            edges = " + ".join(f"coalesce({cell('_edges', x, None)}, 0)" for x in s.sources)
            out = f"coalesce(sum({edges}) {so_far} > 0, false)"
        outputs.append(f"{out} AS {s.name}")

    merged = rows.groupBy(*keys, (F.col("_hour") * 2).alias("_h")).agg(*[F.expr(e).alias(name) for name, e in cells.items()])
    return (
        merged.unionByName(points, allowMissingColumns=True)
        .selectExpr(*keys, "_h", "_grid", *outputs)
        .filter("_grid")
        .select(*keys, from_hour(floor_div(F.col("_h"), 2)).alias(t), "_h", *[s.name for s in signals])
    )


def hourly_signals(grid: DataFrame, keys: Sequence[str], sources: dict[str, Events | Intervals],
                   signals: Sequence[Signal], t: str = "t") -> DataFrame:
    """`hourly_state` without its layout column."""
    return hourly_state(grid, keys, sources, signals, t).drop("_h")


def pivot_latest(grid: DataFrame, keys: Sequence[str], events: Events, kinds: dict[str, str], hours: int = 24,
                 t: str = "t") -> DataFrame:
    """Newest value per kind within the lookback, one column per kind -> name."""
    signals = [Latest(name, "events", kind, hours) for kind, name in kinds.items()]
    return hourly_signals(grid, keys, {"events": events}, signals, t)


def _is_decimal(source: Events | Intervals) -> bool:
    return isinstance(source, Events) and bool(source.value) and isinstance(source.df.schema[source.value].dataType, DecimalType)


def _event_cells(source: Events, keys: list[str], wanted: list[tuple[str | None, int]]) -> DataFrame:
    """Long rows (keys, _hour, _code, _value, _ord), one per event and matched kind."""
    ts = F.col(source.ts)
    value = F.col(source.value).cast("double") if source.value else F.lit(None).cast("double")
    exact = [F.col(source.value).alias("_exact")] if _is_decimal(source) else []
    whole = [code for kind, code in wanted if kind is None]
    match = F.lit(None).cast("int")
    for kind, code in wanted:
        if kind is not None:
            match = F.when(F.col(source.kind) == kind, F.lit(code)).otherwise(match)
    if not whole:
        coded = match
    elif len(wanted) == 1:
        coded = F.lit(whole[0])
    else:
        coded = F.explode(F.array_compact(F.array(F.lit(whole[0]), match)))
    hour = hour_ceil(ts)
    # Order inside one hour cell, packed into one fixed-width number so that the aggregate stays a hash aggregate:
    # microseconds first, then the tiebreak, or 31 hash bits of the value to keep results repeatable without one.
    offset = micros(ts) - (hour - F.lit(1)) * F.lit(HOUR_US)
    if source.tiebreak:
        tie = F.col(source.tiebreak).cast("decimal(19,0)")
        order = offset.cast("decimal(10,0)") * F.lit(Decimal(10**19)) + tie
    else:
        order = offset * F.lit(2**31) + F.pmod(F.hash(value), F.lit(2**31))
    return (
        source.df.filter(ts.isNotNull())
        .select(*keys, hour.alias("_hour"), coded.alias("_code"), value.alias("_value"), order.alias("_ord"), *exact)
        .filter(F.col("_code").isNotNull())
    )


def _interval_edges(source: Intervals, keys: list[str], wanted: list[tuple[str | None, int]]) -> DataFrame:
    """+1 at the first covered hour, -1 at the first hour after the interval.

    The running sum of edges counts the open intervals, so an interval costs two rows instead of one per covered hour,
    and overlapping intervals add up before the shuffle.
    """
    lo, hi = hour_ceil(source.start), hour_ceil(source.end)
    edges = F.array(
        F.struct(F.col("_lo").alias("_hour"), F.lit(1).cast("long").alias("_edge")),
        F.struct(F.col("_hi").alias("_hour"), F.lit(-1).cast("long").alias("_edge")),
    )
    return (
        source.df.select(*keys, lo.alias("_lo"), hi.alias("_hi"))
        .filter(F.col("_hi") > F.col("_lo"))
        .select(*keys, F.lit(wanted[0][1]).alias("_code"), F.inline(edges))
    )
