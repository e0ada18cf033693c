"""How many boosted trees to keep: the average precision of every prefix of an ensemble, exactly.

A row's scores after 1, 2, ... trees are the prefix sums of what each tree adds. Counts per (number of trees, score) give the curve:
running totals within score ranges, on top of the totals of higher ranges, so no number of trees is ordered in one task. The number
kept is the best one before `patience` trees in a row have brought nothing better.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.storage import stage

RANGES = 256


def leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """What each leaf of each tree adds to the score; leaves in the order of the model's leaf numbers, left before right."""
    return [[weight * float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)]
            for tree, weight in zip(model.trees, model.treeWeights)]


def tree_scores(model: GBTClassificationModel, df: DataFrame, name: str = "parts") -> DataFrame:
    """Array of what each tree adds to a row's score."""
    values = F.array(*[F.array(*map(F.lit, leaves)) for leaves in leaf_values(model)])
    leaf = GBTClassificationModel(model._java_obj.copy(model._java_obj.extractParamMap()))
    found = leaf.setLeafCol("_leaf").transform(df).drop("rawPrediction", "probability", "prediction")
    at = vector_to_array("_leaf")
    return found.withColumn(name, F.zip_with(at, values, lambda k, v: F.element_at(v, k.cast("int") + 1))).drop("_leaf")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def prefix_sums(parts: pd.Series) -> pd.Series:
    return parts.map(lambda p: None if p is None else np.cumsum(p))


def probability_after(parts: str, trees: int) -> Column:
    """Probability after the first `trees` trees; the loss works on twice the score."""
    total = F.aggregate(F.slice(parts, 1, trees), F.lit(0.0), lambda a, x: a + x)
    return 1 / (1 + F.exp(-2 * total))


def prefix_average_precision(df: DataFrame, label: str, parts: str = "parts") -> DataFrame:
    """(trees, average_precision) for every prefix; rows without a label or scores stay out, and without positives it is NULL."""
    steps = F.posexplode(prefix_sums(parts)).alias("_at", "score")
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("long").alias("y"), steps)
    counts = rows.groupBy((F.col("_at") + 1).alias("trees"), "score").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    # any monotone range serves; this one spreads scores around zero
    counts = counts.withColumn("range", F.floor(RANGES / (1 + F.exp(-2 * F.col("score")))))
    totals = counts.groupBy("trees", "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    higher = Window.partitionBy("trees").orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)  # <= RANGES + 1 rows
    above = totals.select("trees", "range", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_above") for c in "pn"])
    inside = Window.partitionBy("trees", "range").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("trees", "range", "pos", F.sum("pos").over(inside).alias("tp"), F.sum("neg").over(inside).alias("fp")).join(above, ["trees", "range"])
    hit = F.col("tp") + F.col("p_above")
    return ranked.groupBy("trees").agg(F.sum("pos").alias("n_pos"), F.sum(F.col("pos") * hit / (hit + F.col("fp") + F.col("n_above"))).alias("hits")).select(
        "trees", F.when(F.col("n_pos") > 0, F.col("hits") / F.col("n_pos")).alias("average_precision"))


def with_choice(curve: DataFrame, patience: int = 120) -> DataFrame:
    """The curve with `chosen`, true for the first best prefix up to where `patience` trees in a row were no better. Ties: fewer trees."""
    so_far = Window.orderBy("trees").rowsBetween(Window.unboundedPreceding, 0)    # one row per tree
    earlier = Window.orderBy("trees").rowsBetween(Window.unboundedPreceding, -1)
    best = F.max("average_precision").over(earlier)
    rows = curve.withColumn("_better", F.when(F.col("average_precision").isNotNull() & (best.isNull() | (F.col("average_precision") > best)), F.col("trees")))
    rows = rows.withColumn("_last", F.max("_better").over(so_far))
    rows = rows.withColumn("_live", F.min(F.col("trees") - F.col("_last") < patience).over(so_far))
    chosen = F.max(F.when(F.col("_live"), F.col("_last"))).over(Window.partitionBy())
    return rows.select("trees", "average_precision", (F.col("trees") == chosen).alias("chosen"))


def best_prefix(curve: DataFrame, patience: int = 120) -> int:
    found = with_choice(curve, patience).where("chosen").first()
    return found["trees"] if found else 0


# --- leaf values ------------------------------------------------------------------------------------------------------


def refit_leaves(df: DataFrame, label: str, leaves: str, weight: str | None = None, l2: float = 3.0, rate: float = 0.05,
                 iterations: int = 4, keep: int = 16) -> list[dict[int, float]]:
    """New leaf values of given trees, one tree after the other, with a penalty on their squares.

    `leaves` holds each row's leaf in every tree. A tree's values start at zero and take `iterations` Newton steps
    sum(g) / (sum(h) + l2) at the scores that include them; scaled by `rate` they are added to the score of the rows. A step is one
    aggregate by leaf, which combines map-side. Scores are written every `keep` trees, so plans stay short. Rows without a label, or
    a leaf in some tree, stay out.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = stage(df.where(F.col(label).isNotNull() & F.col(leaves).isNotNull()).select(
        F.col(label).cast("double").alias("y"), w.alias("w"), F.col(leaves).alias("leaves"), F.lit(0.0).alias("score")), "leaves")
    first = rows.select(F.size("leaves").alias("n")).first()
    out: list[dict[int, float]] = []
    for tree in range(first["n"] if first else 0):
        leaf, values = F.element_at("leaves", tree + 1), {}
        for _ in range(iterations):
            p = 1 / (1 + F.exp(-(F.col("score") + _value(values, leaf))))
            found = rows.select(leaf.alias("leaf"), "y", "w", p.alias("p")).where("leaf is not null").groupBy("leaf").agg(
                F.sum(F.expr("w * (y - p)")).alias("g"), F.sum(F.expr("w * p * (1 - p)")).alias("h")).collect()
            values = {r["leaf"]: values.get(r["leaf"], 0.0) + r["g"] / (r["h"] + l2) for r in found}
        out.append({k: rate * v for k, v in sorted(values.items())})
        rows = rows.withColumn("score", F.col("score") + _value(out[-1], leaf))
        if (tree + 1) % keep == 0:
            rows = stage(rows, "leaves")
    return out


def _value(values: dict[int, float], leaf: Column) -> Column:
    """The value of a leaf; a tree has at most as many as its depth allows."""
    if not values:
        return F.lit(0.0)
    table = F.map_from_arrays(F.array(*[F.lit(int(k)) for k in values]), F.array(*[F.lit(float(v)) for v in values.values()]))
    return F.coalesce(F.element_at(table, leaf), F.lit(0.0))
