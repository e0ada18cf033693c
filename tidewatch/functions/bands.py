"""Banded scores, guarded ratios and range cleaning.

Inputs are column names; each function builds one SQL expression, which keeps plan building cheap for wide tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ladder(x: str, cuts: Sequence[float], direction: str, points: Sequence[int] | None = None) -> str:
    points = list(points) if points is not None else list(range(len(cuts) + 1))
    sign = {"down": ">=", "up": "<"}[direction]
    steps = " ".join(f"WHEN {x} {sign} {cut}D THEN {score}" for cut, score in zip(cuts, points))
    return f"CASE WHEN {x} IS NULL THEN NULL {steps} ELSE {points[-1]} END"


def bands(x: str, cuts: Sequence[float], direction: str, points: Sequence[int] | None = None) -> Column:
    """Score x by cut values, NULL in gives NULL out.

    direction "down": cuts fall, score i is the first with x >= cuts[i].
    direction "up": cuts rise, score i is the first with x < cuts[i].
    The last score is what remains.
    """
    return F.expr(_ladder(x, cuts, direction, points))


def two_source_bands(primary: str, fallback: str, cuts: Sequence[float], fallback_cuts: Sequence[float]) -> Column:
    """Descending bands of the primary, of the fallback only where the primary is NULL."""
    return F.expr(f"coalesce({_ladder(primary, cuts, 'down')}, {_ladder(fallback, fallback_cuts, 'down')})")


def bands_with_fallback(x: str, cuts: Sequence[float], alt: str, alt_cuts: Sequence[float],
                        alt_points: Sequence[int]) -> Column:
    """Rising bands of x, else falling bands of alt with their own points."""
    return F.expr(f"coalesce({_ladder(x, cuts, 'up')}, {_ladder(alt, alt_cuts, 'down', alt_points)})")


def gated_score(flag: str, x: str, cut: float, on_score: int = 3) -> Column:
    """on_score while the flag holds; with the flag off 0/1 around the cut; NULL otherwise."""
    return F.expr(f"CASE WHEN {flag} THEN {on_score} WHEN NOT {flag} AND {x} >= {cut}D THEN 0 "
                  f"WHEN NOT {flag} AND {x} IS NOT NULL THEN 1 END")


def null_safe_total(*columns: str) -> Column:
    return F.expr(" + ".join(f"coalesce({c}, 0)" for c in columns))


def guarded_ratio(num: str, den: str, scale: float = 100.0) -> Column:
    """num / (den / scale) where both are present and den is positive, else NULL."""
    return F.expr(f"CASE WHEN {num} IS NOT NULL AND {den} > 0 THEN {num} / ({den} / {scale}D) END")


def unit_normalise(x: str, fraction=(0.15, 1.5), percent=(15.0, 100.0)) -> Column:
    """Fractions become percent, percents stay, everything else is NULL."""
    return F.expr(f"CASE WHEN {x} BETWEEN {fraction[0]}D AND {fraction[1]}D THEN {x} * 100D "
                  f"WHEN {x} BETWEEN {percent[0]}D AND {percent[1]}D THEN {x} END")


def range_clean(x: str, lo: float, hi: float) -> Column:
    return F.expr(f"CASE WHEN {x} BETWEEN {lo}D AND {hi}D THEN {x} END")


def clean_ratio(num: str, den: str, num_range=(50.0, 100.0), den_range=(15.0, 100.0)) -> Column:
    """num over den percent, only with both inside their ranges."""
    return F.expr(f"CASE WHEN {num} BETWEEN {num_range[0]}D AND {num_range[1]}D "
                  f"AND {den} BETWEEN {den_range[0]}D AND {den_range[1]}D THEN {num} / ({den} / 100D) END")


def horizon_label(t: str, onset: str, hours: int) -> Column:
    """1 for t < onset < t + hours, 0 when onset is NULL or t + hours <= onset, NULL at or after the onset."""
    ahead = f"{t} + INTERVAL {int(hours)} HOUR"
    return F.expr(f"CASE WHEN {t} < {onset} AND {onset} < {ahead} THEN 1 "
                  f"WHEN {onset} IS NULL OR {ahead} <= {onset} THEN 0 END")


def split_by_year(ts: str, last_train_year: int) -> Column:
    """'train' up to the year, 'test' after it, NULL where the date is missing."""
    return F.expr(f"CASE WHEN year({ts}) <= {int(last_train_year)} THEN 'train' WHEN {ts} IS NOT NULL THEN 'test' END")


def flag_to_int(flag: str) -> Column:
    return F.col(flag).cast("int")


def sigmoid(x: str) -> Column:
    return F.expr(f"1D / (1D + exp(-{x}))")
