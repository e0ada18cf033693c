"""Exact evaluation of scores: ranking metrics, threshold sweeps, confusion counts, class weights, coverage.

Everything starts from counts per score or per threshold step, which combine map-side, so no step handles rows one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.cohort import first_per

SWEEP_19 = tuple(i / 20 for i in range(1, 20))
SWEEP_9 = tuple(i / 10 for i in range(1, 10))


def ranked_counts(df: DataFrame, p: str, y: str, parts: int = 256) -> DataFrame:
    """Per distinct score, highest first: pos, neg and the running tp, fp down to that score.

    Running totals over all scores would order everything in one task. Scores are cut into ranges instead; the ranges
    only balance the work, any cut points give the same totals. `parts` + 1 range totals are the only broadcast.
    """
    scores = df.filter(F.col(p).isNotNull()).groupBy(F.col(p).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum(1 - F.col(y).cast("long")).alias("neg"))
    cuts = sorted(set(scores.approxQuantile("score", [i / parts for i in range(1, parts)], 0.25 / parts)))
    splits = [float("-inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="score", outputCol="_range").transform(scores)
    ranges = ranged.groupBy("_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    higher = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)  # <= parts + 1 rows
    offsets = ranges.select("_range", F.coalesce(F.sum("_pos").over(higher), F.lit(0)).alias("_pos"),
                            F.coalesce(F.sum("_neg").over(higher), F.lit(0)).alias("_neg"))
    inside = Window.partitionBy("_range").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("tp", F.sum("pos").over(inside)).withColumn("fp", F.sum("neg").over(inside))
        .join(F.broadcast(offsets), "_range")
        .select("score", "pos", "neg", (F.col("tp") + F.col("_pos")).alias("tp"), (F.col("fp") + F.col("_neg")).alias("fp"))
    )


def ranking_metrics(df: DataFrame, p: str, y: str, parts: int = 256) -> DataFrame:
    """One row: n_pos, n_neg, auroc (ties count half) and step-wise average_precision; NULL where a class is missing."""
    sums = ranked_counts(df, p, y, parts).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.expr("CAST(pos AS decimal(18,0)) * CAST(neg - 2 * fp AS decimal(19,0))")).alias("_area"),
        F.sum(F.expr("pos * (tp / (tp + fp))")).alias("_hits"))
    pairs = "(CAST(n_pos AS double) * n_neg)"
    return sums.select(
        "n_pos", "n_neg",
        F.expr(f"CASE WHEN n_pos > 0 AND n_neg > 0 THEN 1D + CAST(_area AS double) / 2D / {pairs} END").alias("auroc"),
        F.expr("CASE WHEN n_pos > 0 THEN _hits / n_pos END").alias("average_precision"))


def auroc(df: DataFrame, p: str, y: str) -> DataFrame:
    return ranking_metrics(df, p, y).select("auroc")


def average_precision(df: DataFrame, p: str, y: str) -> DataFrame:
    return ranking_metrics(df, p, y).select("average_precision")


RATES = {
    "precision": "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0D END",
    "recall": "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0D END",
    "f1": "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0D END",
}


def _with_rates(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[F.expr(e).alias(n) for n, e in RATES.items()])


def threshold_sweep(df: DataFrame, p: str, y: str, grid: Sequence[float] = SWEEP_19,
                    by: Sequence[str] = ()) -> DataFrame:
    """Counts, precision, recall and f1 per threshold; a row is predicted positive iff p >= threshold.

    One aggregate counts rows by the number of thresholds they reach; only that small result is spread over the grid.
    """
    grid = sorted(grid)
    reached = " + ".join(f"if({p} >= {g!r}D, 1, 0)" for g in grid)
    counts = df.filter(F.col(p).isNotNull()).groupBy(*by, F.expr(reached).alias("_reached")).agg(
        F.sum(F.col(y).cast("long")).alias("_pos"), F.sum(1 - F.col(y).cast("long")).alias("_neg"))
    steps = F.posexplode(F.array(*[F.lit(float(g)) for g in grid])).alias("_step", "threshold")
    hit = "_step < _reached"
    return _with_rates(
        counts.select("*", steps).groupBy(*by, "threshold").agg(
            F.expr(f"sum(if({hit}, _pos, 0))").alias("tp"), F.expr(f"sum(if({hit}, _neg, 0))").alias("fp"),
            F.expr(f"sum(if({hit}, 0, _pos))").alias("fn"), F.expr(f"sum(if({hit}, 0, _neg))").alias("tn")))


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Top row by f1, then recall, then precision; the lowest threshold decides what is left."""
    order = [F.col("f1").desc(), F.col("recall").desc(), F.col("precision").desc(), F.col("threshold")]
    return first_per(sweep, by, order) if by else sweep.orderBy(*order).limit(1)


def apply_threshold(df: DataFrame, p: str, threshold: float | DataFrame, name: str = "predicted") -> DataFrame:
    """0/1 prediction at a frozen threshold, given as a number or as the row `best_threshold` returns."""
    cut = threshold.select("threshold").scalar() if isinstance(threshold, DataFrame) else F.lit(float(threshold))
    return df.withColumn(name, (F.col(p) >= cut).cast("int"))


def confusion(df: DataFrame, y: str, predicted: str = "predicted") -> DataFrame:
    """One row with tn, fp, fn, tp, precision, recall, f1."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return _with_rates(df.filter(F.col(predicted).isNotNull()).agg(*[
        F.count(F.when((F.col(y) == a) & (F.col(predicted) == b), 1)).alias(n) for n, (a, b) in cells.items()]))


def class_weights(df: DataFrame, label: str, mode: str = "ratio", eps: float = 1e-12) -> DataFrame:
    """One row: rate, w_neg, w_pos. "ratio" weighs positives (1 - r) / max(r, eps); "balanced" is n / (2 n_class)."""
    base = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("k"))
    rate = "CAST(k AS double) / n"
    pick = {
        "ratio": ("1D", f"(1D - {rate}) / greatest({rate}, {eps!r}D)"),
        "balanced": ("if(n > k, n / (2D * (n - k)), 1D)", "if(k > 0, n / (2D * k), 1D)"),
    }[mode]
    return base.select(F.expr(rate).alias("rate"), F.expr(pick[0]).alias("w_neg"), F.expr(pick[1]).alias("w_pos"))


def coverage(df: DataFrame, p: str) -> DataFrame:
    return df.agg(F.count(p).alias("used"), F.count(F.lit(1)).alias("total"))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(*columns)
