"""Numbers in place of categories: label means over earlier rows of a fixed random order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_target_statistics(df: DataFrame, categories: Sequence[str], label: str, key: str, prior_weight: float = 1.0,
                              seed: int = 42, digits: int = 3, suffix: str = "_target") -> DataFrame:
    """`key` and, per category, (label sum + prior_weight * rate) / (rows + prior_weight) over the rows of its value that come earlier.

    Rows are ordered by the MD5 of seed and key, so a row's own label never enters its number. Rows without a label come after all
    others and see the whole value. A missing value is the category "nan"; `rate` is the label mean, NULL without labels. Keys must
    be unique.

    A value's rows are split into 16^digits runs by the first digits of the hash. Sums per run are added up first (they combine
    map-side), rows are ordered only within their run: a value that a third of all rows hold is thousands of even windows.
    """
    rate = df.agg(F.avg(label).alias("rate"))
    pairs = [F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value")) for c in categories]
    rows = df.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("y"),
                     F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))).alias("h"), F.explode(F.array(*pairs)).alias("c"))
    rows = rows.select("_key", "y", "h", "c.name", "c.value", F.substring("h", 1, digits).alias("run"))
    by = ["name", "value", "run"]
    whole = Window.partitionBy("name", "value")
    earlier = whole.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)      # one row per run
    runs = rows.groupBy(*by).agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("s"), F.count("y").alias("n")).select(
        *by, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in "sn"],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in "sn"])
    inside = Window.partitionBy(*by).orderBy("h", "_key").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.select("*", F.coalesce(F.sum("y").over(inside), F.lit(0.0)).alias("s_in"), F.count("y").over(inside).alias("n_in"))
    known = F.col("y").isNotNull()
    total = F.when(known, F.col("s_in") + F.col("s_before")).otherwise(F.col("s_all"))
    size = F.when(known, F.col("n_in") + F.col("n_before")).otherwise(F.col("n_all"))
    prior = rate.scalar()
    coded = seen.join(runs, by).select("_key", "name", ((total + prior_weight * prior) / (size + prior_weight)).alias("code"))
    wide = coded.groupBy("_key").agg(*[F.max(F.when(F.col("name") == c, F.col("code"))).alias(f"{c}{suffix}") for c in categories])
    return wide.withColumnRenamed("_key", key)
